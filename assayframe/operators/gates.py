"""Text gates over notes, the relevance score, redaction and gate routing.

The work is split in two projections: ``with_signals`` reads the text once per pattern
and keeps numbers and short arrays; issues, score and routing are built from those. The
signals are columns of their own and not one struct, because the optimizer inlines a
struct into every place that reads a field of it, and would search the text again there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.patterns import by_first_letter
from ..functions.predicates import SPACE, java_pattern, match_count, word_count
from ..functions.sql import NULL, name, say, text
from .issues import found_sql, issue, pinned


@dataclass(frozen=True)
class PhiPattern:
    """``clue`` is a cheaper pattern, found in just the texts the full one is found in;
    ``linear`` finds the same matches, but is tried only where one can begin; ``needs`` is
    a literal every match contains, ``near`` a cheaper pattern found in every match."""

    name: str
    pattern: str
    ignore_case: bool = False
    clue: str | None = None
    linear: str | None = None
    needs: str | None = None
    near: str | None = None


@dataclass(frozen=True)
class GatePatterns:
    profanity: str = fv.PROFANITY_PATTERN
    terms: str = fv.TERM_PATTERN
    bias: str = fv.BIAS_PATTERN
    sections: str = fv.SECTION_PATTERN
    phi: tuple[PhiPattern, ...] = field(default_factory=lambda: (
        PhiPattern("SSN", fv.SSN_PATTERN, needs="-"),
        PhiPattern("email", fv.EMAIL_PATTERN, needs="@", clue=r"[\w.+-]@[\w-]+\.[\w.-]",
                   linear=r"(?:\G|(?<![\w.+-]))[\w.+-]++@[\w-]+\.[\w.-]+"),
        PhiPattern("phone_number", fv.PHONE_PATTERN, near=r"\d{3}[-.\s]?\d{4}"),
        PhiPattern("street_address", fv.ADDRESS_PATTERN, ignore_case=True),
    ))


#: A sentence of three or more words: a run without sentence ends holding two gaps.
#: Possessive, and only tried at word starts, so long unbroken text stays linear.
_FULL_SENTENCE = (rf"(?U)(?<![^.!?{SPACE}])[^.!?{SPACE}]++[{SPACE}]++[^.!?{SPACE}]++[{SPACE}]++"
                  r"[^.!?" + SPACE + r"]++[^.!?]*+")


def find_words(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of a list of words, whatever their case."""
    return F.regexp_extract_all(text, F.lit(java_pattern(by_first_letter(pattern), True)),
                                F.lit(group))


def _has_phi(text: Column, phi: PhiPattern) -> Column:
    found = text.rlike(java_pattern(phi.clue or phi.pattern, phi.ignore_case))
    if phi.near:
        found = text.rlike(java_pattern(phi.near, phi.ignore_case)) & found
    return F.contains(text, F.lit(phi.needs)) & found if phi.needs else found


SIGNAL = "_signal_"


def text_signals(note: Column, patterns: GatePatterns = GatePatterns()) -> dict[str, Column]:
    """Everything the gates and the score need to know about a note."""
    body = F.coalesce(note, F.lit(""))
    return {
        "words": word_count(body),
        "chars": F.length(body),
        "letters": F.length(body) - match_count(body, rf"(?U)[^\p{{L}}{SPACE}]"),
        "profanity": find_words(body, patterns.profanity),
        "phi": F.concat(*[F.when(_has_phi(body, p), F.array(F.lit(p.name))).otherwise(
            F.array().cast("array<string>")) for p in patterns.phi]),
        "distinct_terms": F.size(F.array_distinct(find_words(body, patterns.terms))),
        "bias": find_words(body, patterns.bias),
        "sections": F.size(find_words(body, patterns.sections)),
        "full_sentences": F.regexp_count(body, F.lit(_FULL_SENTENCE)),
        "sentences": match_count(body, "[.!?]+") + 1,
    }


def with_signals(df: DataFrame, note: str, patterns: GatePatterns = GatePatterns()) -> DataFrame:
    signals = text_signals(F.col(note), patterns)
    return df.withColumns({SIGNAL + n: signal for n, signal in signals.items()})


def drop_signals(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(SIGNAL)])


def _signal(which: str) -> Column:
    return F.col(SIGNAL + which)


#: Matches that an issue shows.
SHOWN = 3


def gate_issues(record_id: str, shown: int = SHOWN) -> Column:
    """The issues of a note with signals, in the order of the checks; ``shown`` matches are
    listed, all are counted. The advice on personal data names no service."""
    def _first3(found: str, between: str = "', '") -> str:
        return f"array_join(slice({found}, 1, {shown}), {between})"

    s = {n: SIGNAL + n for n in ("words", "profanity", "phi", "bias", "distinct_terms", "sections",
                                 "full_sentences")}
    rid = f"coalesce(CAST({name(record_id)} AS STRING), 'unknown')"
    words = f"CAST({s['words']} AS STRING)"
    ratio = f"try_divide({SIGNAL}letters, {SIGNAL}chars)"
    # The matches shown, as a Python list prints them.
    listed = (f"concat('[\\'', replace(replace({_first3(s['bias'], text(chr(39) + ', ' + chr(39)))},"
              r" '\n', '\\n'), '\t', '\\t'), '\']')")

    def gate(test, kind, severity, *message, value=NULL):
        return found_sql((test, issue(kind, "clinical_note", severity, say(*message), value)))

    checks = ", ".join([
        gate(f"size({s['profanity']}) > 0", "RA_PROFANITY", "ERROR",
             text("Profanity/inappropriate language detected in note for record "), rid, "': '",
             f"CAST(size({s['profanity']}) AS STRING)",
             text(" occurrence(s). Record BLOCKED from FM consumption."),
             value=_first3(s["profanity"])),
        gate(f"size({s['phi']}) > 0", "RA_PHI_EXPOSURE", "WARNING",
             text("Potential PHI detected in note for record "), rid, "': '",
             f"array_join({s['phi']}, ', ')",
             text(". Route through de-identification before FM consumption."),
             value=f"array_join({s['phi']}, ', ')"),
        gate(f"{s['words']} < {fv.MIN_WORDS}", "RA_LOW_RELEVANCE", "WARNING",
             text("Clinical note for record "), rid, "' has only '", words,
             text(f" words (minimum {fv.MIN_WORDS} recommended). May be too short for useful FM "
                  "analysis."), value=words),
        gate(f"{s['distinct_terms']} = 0", "RA_LOW_RELEVANCE", "WARNING",
             text("Clinical note for record "), rid,
             text(" contains no recognized medical terminology. May not be a valid clinical "
                  "note.")),
        gate(f"{ratio} < {fv.MIN_ALPHA_RATIO}D", "RA_GARBLED_TEXT", "WARNING",
             text("Clinical note for record "), rid, "' has low alphabetic ratio ('",
             f"format_string('%.1f%%', {ratio} * 100)",
             text("). Possible garbled OCR or data corruption."),
             value=f"CAST(round({ratio}, 3) AS STRING)"),
        gate(f"size({s['bias']}) > 0", "RA_BIAS_INDICATOR", "WARNING",
             text("Bias-loaded language detected in note for record "), rid, "': '", listed,
             text(". This phrasing may inappropriately influence FM reasoning. Consider neutral "
                  "clinical language."), value=_first3(s["bias"])),
        gate(f"{s['full_sentences']} = 0", "RA_LOW_COHERENCE", "WARNING",
             text("Clinical note for record "), rid,
             text(" has no complete sentences. May be a fragment, keyword list, or data "
                  "artifact.")),
        gate(f"{s['sections']} = 0 AND {s['words']} >= {fv.STRUCTURE_WORDS}",
             "RA_UNSTRUCTURED_NOTE", "WARNING",
             text("Clinical note for record "), rid, "' ('", words,
             text(" words) lacks standard clinical sections (Assessment, Plan, etc.). Structured "
                  "notes produce better FM outputs.")),
    ])
    empty = issue("RA_EMPTY_NOTE", "clinical_note", "WARNING",
                  text("Clinical note is empty — no content to send to FM"))
    return F.expr(f"CASE WHEN {s['words']} = 0 THEN array({empty}) ELSE concat({checks}) END")


def relevance_score() -> Column:
    """0 to 100 for a note with signals: length, term density, section headings and
    complete sentences."""
    s = _signal
    words = s("words")

    def capped(value):
        return F.least(value, F.lit(1.0))

    total = (capped(words / 50.0) * 30.0
             + capped(F.try_divide(s("distinct_terms"), words) * 10) * 30.0
             + capped(s("sections") / 3.0) * 20.0
             + s("full_sentences") / s("sentences") * 20.0)
    return F.when(words == 0, 0.0).otherwise(F.round(F.least(total, F.lit(100.0)), 1))


def with_gates(df: DataFrame, note: str, record_id: str,
               patterns: GatePatterns = GatePatterns(), shown: int = SHOWN) -> DataFrame:
    """Adds ``gate_issues`` and ``relevance_score``. Issues show ``shown`` matches."""
    return drop_signals(pinned(with_signals(df, note, patterns), {
        "gate_issues": gate_issues(record_id, shown), "relevance_score": relevance_score()}))


def with_relevance(df: DataFrame, note: str, patterns: GatePatterns = GatePatterns()) -> DataFrame:
    """Adds ``relevance_score`` alone: the text is searched for nothing else."""
    return drop_signals(pinned(with_signals(df, note, patterns),
                               {"relevance_score": relevance_score()}))


def with_route(df: DataFrame, note: str, patterns: GatePatterns = GatePatterns()) -> DataFrame:
    """Adds ``route``, as ``gate_route`` of all gates would give: the text is searched for
    offending words, and for personal data where there are none."""
    body = F.coalesce(F.col(note), F.lit(""))
    offends = body.rlike(java_pattern(by_first_letter(patterns.profanity), True))
    private = F.lit(False)
    for phi in patterns.phi:
        private = private | _has_phi(body, phi)
    wordy = word_count(body) > 0
    return df.withColumn("route", F.when(offends & wordy, "blocked").when(
        private & wordy, "deidentify").otherwise("ready"))


def redact_phi(note: Column, patterns: GatePatterns = GatePatterns()) -> Column:
    """Replaces personal data by its kind in brackets, and ISO dates by ``[DATE]``."""
    for phi in (*patterns.phi, PhiPattern("date", fv.DATE_ENTITY_PATTERN, needs="-")):
        marked = F.regexp_replace(note, java_pattern(phi.linear or phi.pattern, phi.ignore_case),
                                  f"[{phi.name.upper()}]")
        note = F.when(F.contains(note, F.lit(phi.needs)), marked).otherwise(note) \
            if phi.needs else marked
    return note


def gate_route(issues: Column) -> Column:
    """blocked, deidentify or ready."""
    def has(kind):
        return F.exists(issues, lambda i: i["type"] == kind)

    return (F.when(has("RA_PROFANITY"), "blocked").when(has("RA_PHI_EXPOSURE"), "deidentify")
            .otherwise("ready"))
