"""Weighted finite-state transducers over word classes, and their composition.

A transducer reads one symbol of a clause at a time and puts out one, with a factor for its weight.  Symbols:

    o  any other word          y  a target (a person spoken of or to)
    i  an insult               n  a negation
    t  a threatening verb      r  a verb of speech
    q  a quotation mark
    I  an insult that follows a target       B  a target that follows an insult
    T  a threat that has met its target

Four transducers are composed, the output of each being read by the next: threat, target, negation, reported speech.
"""

from __future__ import annotations

from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

SYMBOLS = "oyintrqIBT"
Table = dict[tuple[int, str], tuple[int, str, float]]

# Closed classes of words in English, German, French and Spanish; fixed values.
TARGETS = (
    "you your yours u he she they them him her this these those people "
    "du dich dir dein deine ihr euch euer er sie diese leute "
    "tu toi te ton ta vous votre il elle ils elles ces gens "
    "tú ti usted ustedes vosotros él ella ellos ellas esos gente"
)
NEGATIONS = "not no never neither nor isn aren don nicht nie niemals kein keine ne pas jamais aucun aucune no nunca jamás ningún"
REPORTS = (
    "said says say told tells wrote writes claimed claims quoted quotes called reported "
    "sagte sagt sagen schrieb schreibt behauptete nannte "
    "dit dire disait écrit écrivait affirme "
    "dijo dice decir escribió escribe afirmó llamó"
)
THREATS = (
    "kill hurt beat destroy burn shoot stab smash strangle "
    "töten töte umbringen schlagen verletzen verbrennen erschießen "
    "tuer tue tuerai frapper détruire brûler "
    "matar mataré golpear destruir quemar"
)
THREAT_WEIGHT, BONUS = 2.0, 0.5
DIRECTED, NEGATED, REPORTED = 1.3, 0.4, 0.6
REACH = 4


def _counting(arm: str, fire: dict[str, tuple[str, float]], reach: int) -> Table:
    """After a symbol of ``arm``, the next ``reach`` words are in its scope; symbols of ``fire`` are rewritten there."""
    table: Table = {}
    for state in range(reach + 1):
        for symbol in SYMBOLS:
            out, factor = fire.get(symbol, (symbol, 1.0)) if state else (symbol, 1.0)
            table[state, symbol] = (reach if symbol in arm else max(0, state - 1), out, factor)
    return table


def threat() -> Table:
    """A threatening verb counts once its target follows; alone it is a word like others."""
    table = _counting("t", {"y": ("T", 1.0)}, REACH)
    for state in range(REACH + 1):
        table[state, "t"] = (REACH, "o", 1.0)
        if state:
            table[state, "y"] = (0, "T", 1.0)
    return table


def target() -> Table:
    """An insult within reach of a target before it weighs more; a target soon after an insult adds a bonus."""
    table: Table = {}
    # states: 0 none, 1..REACH a target that long ago (counting down), REACH+1..REACH+2 an insult just before
    for state in range(REACH + 3):
        near, after = 1 <= state <= REACH, state > REACH
        for symbol in SYMBOLS:
            back = state - 1 if near else (state - 1 if state == REACH + 2 else 0)
            if symbol == "i":
                table[state, symbol] = (REACH + 2, "I" if near else "i", DIRECTED if near else 1.0)
            elif symbol in "yT":
                table[state, symbol] = (REACH, "B" if after and symbol == "y" else symbol, 1.0)
            else:
                table[state, symbol] = (back, symbol, 1.0)
    return table


def negation() -> Table:
    return _counting("n", {s: (s, NEGATED) for s in "iIBT"}, REACH - 1)


def reported() -> Table:
    """Behind a verb of speech or an opening quotation mark a clause is someone else's words."""
    table: Table = {}
    for state in range(3):  # 0 own words, 1 reported, 2 between quotation marks
        for symbol in SYMBOLS:
            after = {0: 1 if symbol == "r" else 2 if symbol == "q" else 0, 1: 2 if symbol == "q" else 1, 2: 0 if symbol == "q" else 2}
            table[state, symbol] = (after[state], symbol, REPORTED if state and symbol in "iIBT" else 1.0)
    return table


def compose(first: Table, second: Table) -> Table:
    """The transducer that passes its input through ``first`` and the result through ``second``."""
    width = 1 + max(state for state, _ in second)
    table: Table = {}
    for (a, symbol), (a_next, middle, factor) in first.items():
        for b in range(width):
            b_next, out, more = second[b, middle]
            table[a * width + b, symbol] = (a_next * width + b_next, out, factor * more)
    return table


def clause_grammar() -> Table:
    return compose(compose(compose(threat(), target()), negation()), reported())


def clause_weight(table: Table, clause: list[tuple[str, float]]) -> tuple[float, int]:
    """Total weight and number of the matches in one clause, given as (symbol, weight) in order."""
    state, total, matches = 0, 0.0, 0
    for symbol, weight in clause:
        state, out, factor = table[state, symbol]
        if out in "iI":
            total, matches = total + factor * weight, matches + 1
        elif out == "T":
            total, matches = total + factor * THREAT_WEIGHT, matches + 1
        elif out == "B":
            total += factor * BONUS
    return total, matches
