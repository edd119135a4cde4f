"""User feedback: metadata of recorded messages, bundles, and what is missing where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.functions.ids import bundle_uuid, message_uuid
from fieldcast.functions.text import checked_date, clock, first_key, merged, prefixed
from fieldcast.operators.bundling import next_fit
from fieldcast.operators.lookup import lookup_deployment_number, lookup_recipient_info
from fieldcast.operators.merge import insert_ignore
from fieldcast.tables import Tables, mart

# Property of each uf_messages column (several: the first present counts),
# defaults for missing values, and the bundling limits.
MESSAGE_UUID = "metadata.MESSAGE_UUID"
COLUMN_PROPERTIES = {
    "message_uuid": ("metadata.MESSAGE_UUID",),
    "programid": ("PROJECT",),
    "deploymentnumber": ("DEPLOYMENT_NUMBER",),
    "recipientid": ("RECIPIENTID",),
    "talkingbookid": ("TALKINGBOOKID",),
    "deployment_tbcdid": ("TBCDID",),
    "deployment_timestamp": ("TIMESTAMP",),
    "deployment_user": ("USERNAME",),
    "test_deployment": ("TESTDEPLOYMENT",),
    "collection_tbcdid": ("collection.TBCDID",),
    "collection_timestamp": ("collection.TIMESTAMP",),
    "collection_user": ("collection.USEREMAIL", "collection.USERNAME"),
    "length_seconds": ("metadata.SECONDS",),
    "length_bytes": ("metadata.BYTES",),
    "language": ("metadata.LANGUAGE",),
    "date_recorded": ("metadata.DATE_RECORDED",),
    "relation": ("metadata.RELATION",),
}
DEFAULTS = {
    "deployment_timestamp": "180101",
    "test_deployment": "f",
    "collection_timestamp": "180103",
    "date_recorded": "180102",
}
MIN_SECONDS = 5
MAX_SECONDS = 300
MAX_BYTES = 10_000_000


def uf_map_columns(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Properties map (``props``) -> the columns of uf_messages, as text; records without an id are dropped."""
    props = F.col("props")

    def column(name: str) -> Column:
        value = first_key(props, *COLUMN_PROPERTIES[name])
        if name == "date_recorded":
            value = F.coalesce(checked_date(value), F.lit(""))
        if name == "language":
            value = F.lower(value)
        if name in DEFAULTS:
            value = F.when(value == "", F.lit(DEFAULTS[name])).otherwise(value)
        return value.alias(name)

    return records.where(F.map_contains_key(props, MESSAGE_UUID)).select(
        *(keep or []), *[column(name) for name in COLUMN_PROPERTIES], F.lit(None).cast("string").alias("bundle_uuid")
    )


def uf_typed(rows: DataFrame) -> DataFrame:
    """uf_messages columns in their stored types; text that is no number becomes NULL."""
    whole = ["deploymentnumber", "length_seconds", "length_bytes"]
    return rows.withColumns({c: F.col(c).try_cast("bigint") for c in whole})


def uf_import(messages: DataFrame, records: DataFrame) -> DataFrame:
    """New uf_messages rows of properties records (``path``, ``props``); known messages are left alone."""
    rows = uf_typed(uf_map_columns(records, keep=["path"]))
    return insert_ignore(messages, rows, ["message_uuid"], ["path"])


def uf_extract(
    audio: DataFrame, sidecars: DataFrame, recipients: DataFrame, deployments: DataFrame, exported: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Audio metadata with its sidecar and lookups -> (records, errors).

    ``exported`` (``message_uuid``, ``bytes``) has the sizes of the exported files, which become ``metadata.BYTES``.

    ``audio`` is the result of ``a18_metadata``, ``sidecars`` of ``read_properties``; they
    belong together by path without extension.  Records carry the full map ``props``, ready
    for ``uf_map_columns`` and for the properties sink.
    """
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    name = F.regexp_extract("stem", r"([^/]+)$", 1)
    pairs = audio.withColumn("stem", stem).join(
        sidecars.select(stem.alias("stem"), F.col("props").alias("sidecar")), "stem", "left"
    )
    readable = F.col("error").isNull() & F.col("sidecar").isNotNull()
    unread = pairs.where(~readable).select(
        "path", F.coalesce("error", F.lit("no sidecar")).alias("error")
    )
    named = pairs.where(readable).withColumn("md", merged(F.col("md"), F.create_map(F.lit("filename"), name)))
    ident = F.coalesce(
        F.nullif(F.try_element_at("sidecar", F.lit(MESSAGE_UUID)), F.lit("")),
        message_uuid(F.col("md"), F.try_element_at("sidecar", F.lit("collection.STATSUUID"))),
    )
    known = (
        named.withColumn("uuid", ident)
        .withColumn("program", F.try_element_at("sidecar", F.lit("PROJECT")))
        .withColumn("deployment", F.try_element_at("sidecar", F.lit("DEPLOYMENT")))
        .withColumn("recipientid", F.try_element_at("sidecar", F.lit("RECIPIENTID")))
    )
    sizes = F.create_map().cast("map<string,string>")
    if exported is not None:
        files = exported.select(F.col("message_uuid").alias("uuid"), F.col("bytes").cast("string").alias("exported_bytes"))
        known = known.join(files, "uuid", "left")
        sizes = F.when(F.col("exported_bytes").isNotNull(), F.create_map(F.lit("metadata.BYTES"), "exported_bytes")).otherwise(sizes)
    known = lookup_deployment_number(known, deployments, "program", "deployment")
    known = lookup_recipient_info(known, recipients)
    number = F.coalesce(
        F.nullif(F.try_element_at("sidecar", F.lit("DEPLOYMENT_NUMBER")), F.lit("")),
        F.col("found_number").cast("string"),
        F.lit(""),
    )
    props = merged(
        F.col("sidecar"),
        prefixed(F.col("md"), "metadata."),
        sizes,
        F.create_map(F.lit(MESSAGE_UUID), F.col("uuid"), F.lit("DEPLOYMENT_NUMBER"), number),
        prefixed(F.col("recipient"), "recipient."),
    )
    full = known.select("path", "program", number.alias("number"), props.alias("props"))
    complete = (F.coalesce(F.length("program"), F.lit(0)) > 0) & (F.length("number") > 0)
    lacking = full.where(~complete).select("path", F.lit("no PROJECT or DEPLOYMENT_NUMBER").alias("error"))
    return full.where(complete).select("path", "props"), unread.unionByName(lacking)


def uf_create_properties(
    audio: DataFrame,
    sidecars: DataFrame,
    recipients_map: DataFrame,
    program: str,
    deployment_number: int,
    recipients: DataFrame | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Properties for audio files that have no sidecar; the recipient is found by the parent directory's name.

    Of several map rows with a directory the last by ``order`` counts (without an order, the greatest id).  With
    ``recipients`` the found recipient's attributes are added as ``recipient.*``.
    """
    last = F.max_by("recipientid", F.struct(*order)) if order else F.max("recipientid")
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    bare = (
        audio.where(F.col("error").isNull())
        .withColumn("stem", stem)
        .join(sidecars.select(stem.alias("stem")).distinct(), "stem", "left_anti")
        .withColumn("community", F.upper(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))
    )
    directory = (
        recipients_map.where(F.col("project") == program)
        .groupBy(F.col("directory").alias("community"))
        .agg(last.alias("recipientid"))
    )
    md = merged(F.col("md"), F.create_map(F.lit("filename"), F.regexp_extract("stem", r"([^/]+)$", 1)))
    props = merged(
        F.map_filter(
            F.create_map(
                F.lit("RECIPIENTID"), F.col("recipientid"),
                F.lit("PROJECT"), F.lit(program),
                F.lit("DEPLOYMENT_NUMBER"), F.lit(str(deployment_number)),
                F.lit("TALKINGBOOKID"), F.try_element_at("md", F.lit("PUBLISHER")),
                F.lit("COMMUNITY"), F.col("community"),
            ),
            lambda _, v: v.isNotNull(),
        ),
        prefixed(md, "metadata."),
        F.create_map(F.lit(MESSAGE_UUID), message_uuid(md, F.lit(""))),
    )
    found = bare.join(directory, "community", "left")
    if recipients is None:
        return found.select("path", props.alias("props"))
    known = lookup_recipient_info(found, recipients)
    return known.select("path", merged(props, prefixed(F.col("recipient"), "recipient.")).alias("props"))


def uf_list_metadata(audio: DataFrame) -> DataFrame:
    """One row per metadata value."""
    return audio.where(F.col("error").isNull()).select("path", F.explode("md").alias("key", "value"))


def uf_get_records(messages: DataFrame, program: str | None = None, deployment_number: int | None = None) -> DataFrame:
    """Messages of a program and deployment, by id."""
    if program is not None:
        messages = messages.where(F.col("programid") == program)
    if deployment_number is not None:
        messages = messages.where(F.col("deploymentnumber") == deployment_number)
    return messages.orderBy("message_uuid")


def filter_uf_keep(
    messages: DataFrame, rebundle: bool = False, min_seconds: int = MIN_SECONDS, max_seconds: int = MAX_SECONDS
) -> DataFrame:
    """Messages to bundle: of a fit length, and not bundled yet unless ``rebundle``."""
    fit = messages.where(F.col("length_seconds").between(min_seconds, max_seconds))
    return fit if rebundle else fit.where(F.col("bundle_uuid").isNull())


def uf_bundle(
    messages: DataFrame, max_bytes: int = MAX_BYTES, rows_per_block: int | None = None, max_files: int | None = None, **keep
) -> DataFrame:
    """Bundle number of every kept message: next-fit per program, deployment and language, in id order.

    A bundle is limited in bytes, and in files only if ``max_files`` is given.
    """
    return next_fit(
        filter_uf_keep(messages, **keep), ["programid", "deploymentnumber", "language"], "message_uuid",
        "length_bytes", max_bytes, rows_per_block, max_files=max_files,
    )


def uf_bundle_assign(bundled: DataFrame) -> DataFrame:
    """Add the id of each message's bundle."""
    return bundled.withColumn(
        "bundle_uuid",
        bundle_uuid(F.col("programid"), F.col("deploymentnumber"), F.col("language"), F.col("bundle_index")),
    )


def uf_bundle_regroup(messages: DataFrame, bundles: list[str] | None = None) -> DataFrame:
    """Bundles as stored with the messages, with files, seconds and bytes; the language is that of the first message."""
    stored = messages.where(F.col("bundle_uuid").isNotNull())
    if bundles is not None:
        stored = stored.where(F.col("bundle_uuid").isin(bundles))
    return stored.groupBy("programid", "deploymentnumber", "bundle_uuid").agg(
        F.min_by("language", "message_uuid").alias("language"),
        F.count("*").alias("files"),
        F.sum("length_seconds").alias("seconds"),
        F.sum("length_bytes").alias("bytes"),
    )


def uf_bundle_summary(bundles: DataFrame) -> DataFrame:
    """Bundles with their total duration as text."""
    return bundles.withColumn("total", clock(F.col("seconds")))


def uf_publish_manifest(
    assigned: DataFrame, root: str, zipped: bool = True, limit: int | None = None
) -> DataFrame:
    """Where each published message comes from and goes to.

    The folder is that of the bundle's language, which is its first message's, so a bundle stays in one place.
    Zipped, messages go into one archive per bundle; otherwise each keeps its own file, and
    ``limit`` stops after so many.  Copying the objects is the platform's job.
    """
    bundle = ["programid", "deploymentnumber", "bundle_uuid"]
    first = F.min_by("language", "message_uuid").alias("bundle_language")
    assigned = assigned.join(assigned.groupBy(*bundle).agg(first), bundle)
    number = F.col("deploymentnumber").cast("string")
    source = F.concat_ws("/", F.lit("collected"), "programid", number, F.concat("message_uuid", F.lit(".mp3")))
    folder = F.concat_ws("/", F.lit(root), F.concat(F.lit("deployment-"), number), "bundle_language")
    target = F.concat("bundle_uuid", F.lit(".zip")) if zipped else F.concat("message_uuid", F.lit(".mp3"))
    manifest = assigned.select(
        "programid", "deploymentnumber", "language", "message_uuid", source.alias("in_key"),
        F.concat_ws("/", folder, target).alias("out_key"),
    )
    if limit is not None and not zipped:
        manifest = manifest.orderBy("programid", "deploymentnumber", "language", "message_uuid").limit(limit)
    return manifest


@mart
def missing_uf_not_in_db(t: Tables) -> DataFrame:
    """Collected objects without a message row.

    Both keys are unique non-NULL ids, so the anti join equals NOT IN.
    """
    return (
        t["collected_uuids"]
        .join(t["uf_messages"].select(F.col("message_uuid").alias("uuid")), "uuid", "left_anti")
        .select("url")
    )


@mart
def missing_uf_not_in_store(t: Tables) -> DataFrame:
    """Message rows without a collected object."""
    return (
        t["uf_messages"]
        .join(t["collected_uuids"].select(F.col("uuid").alias("message_uuid")), "message_uuid", "left_anti")
        .select("programid", "deploymentnumber", "language", "message_uuid")
    )
