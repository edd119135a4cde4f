"""Report tables.  Importing this package registers every mart."""

from fieldcast.plans import deployments, feedback, legacy, production, retired, serials, usage  # noqa: F401
