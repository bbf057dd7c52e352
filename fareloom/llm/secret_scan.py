"""Secrets in texts: three fixed forms, and strings whose sliding-window entropy is that of random characters.

Everything is a column expression. Candidate strings are runs of at least `window` characters of the base64 and hex
alphabets. For every window of a candidate the Shannon entropy follows from the counts of its characters, which change by
one character in and one out per step: only the sum of c log c over the counts is carried along. The largest entropy is
compared with the threshold of the string's character class (hex; letters of both cases with digits; letters of one case
with three digits or more and nothing else); strings of one class only, such as long words or numbers, never reach a
threshold. Parts between slashes that are on the allow list do not count. Where a candidate overlaps a fixed form, the
parts of it outside are spans of their own.

Defined results: a null or empty text has no spans; repeated rows and null ids are rows of their own; an empty table gives
no rows. Columns other than doc_id and text are not read by the scan; redaction keeps them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import numbered, text_column
from fareloom.llm.spans import before_each, by_start, kept, located, named, once, written

# The forms of the base scan.
ASSIGN = r"(?i:(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
PIECE = 256  # windows that begin in one piece of a candidate
HEX_BITS = 3.0
MIXED_BITS = 3.8
ONE_CASE_BITS = 3.7
# Strings that look random and are not secret: UUIDs, written-out alphabets and digits, stand-ins.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)abcdefgh|0123456789",
    r"(?i)example|sample|placeholder|changeme|dummy|your[-_]",
)


def peak_entropy(text: Column, window: int) -> Column:
    """The largest Shannon entropy in bits of any window of the text, which has at least that many characters.

    The text is walked in pieces that overlap by a window less one, so that reaching a character costs a piece's length
    at most. A step counts only the entering and the leaving character, among the characters that stay.
    """
    weights = F.lit([0.0, 0.0, *(n * math.log2(n) for n in range(2, window + 1))])

    def peak(piece: Column) -> Column:
        letter = lambda i: F.substring(piece, i, F.lit(1))
        weight = lambda count: F.get(weights, count)

        def step(state: Column, i: Column) -> Column:
            staying = F.substring(piece, F.greatest(i - window + 1, F.lit(1)), F.least(i, F.lit(window)) - 1)
            others = lambda rest, c: F.length(rest) - F.length(F.replace(rest, c, F.lit("")))
            counts = once(staying, lambda rest: F.struct(
                others(rest, letter(i)).alias("entering"),
                F.when(i > window, others(rest, letter(i - window))).otherwise(0).alias("leaving")))
            total = once(counts, lambda n: state["sum"] + weight(n["leaving"]) - F.when(i > window, weight(n["leaving"] + 1)).otherwise(0.0)
                         + weight(n["entering"] + 1) - weight(n["entering"]))
            return once(total, lambda now: F.struct(now.alias("sum"), F.when(i >= window, F.greatest(
                state["peak"], F.log2(F.lit(float(window))) - now / window)).otherwise(state["peak"]).alias("peak")))

        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"))
        return F.aggregate(F.sequence(F.lit(1), F.length(piece)), start, step, lambda s: s["peak"])

    def walked(letters: Column) -> Column:
        ways = F.sequence(F.lit(0), F.greatest(F.size(letters) - window, F.lit(0)), F.lit(PIECE))
        pieces = F.transform(ways, lambda at: F.array_join(F.slice(letters, at + 1, PIECE + window - 1), ""))
        return F.array_max(F.transform(pieces, peak))

    return once(F.split(text, ""), walked)


def random_looking(text: Column, window: int = WINDOW, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Whether what is left of a candidate string reaches the threshold of its character class.

    Parts between slashes that are on the allow list are taken out first; they do not hide what stands beside them.
    """
    def judged(rest: Column) -> Column:
        is_hex = rest.rlike("^[0-9a-fA-F]+$") & rest.rlike("[0-9]") & rest.rlike("[a-fA-F]")
        is_mixed = rest.rlike("[0-9]") & rest.rlike("[a-z]") & rest.rlike("[A-Z]")
        one_case = rest.rlike("^([a-z0-9]+|[A-Z0-9]+)$") & rest.rlike("[A-Za-z]") & rest.rlike("([0-9].*){3}")
        threshold = F.when(is_hex, HEX_BITS).when(is_mixed, MIXED_BITS).otherwise(ONE_CASE_BITS)
        able = (F.length(rest) >= window) & (is_hex | is_mixed | one_case)
        return F.when(able, peak_entropy(rest, window) >= threshold).otherwise(False)

    def unlisted(part: Column) -> Column:
        listed = F.lit(False)
        for pattern in allowed:
            listed = listed | part.rlike(pattern)
        return ~listed

    return once(F.array_join(F.filter(F.split(text, "/"), unlisted), "/"), judged)


def base_spans(text: Column) -> dict[str, Column]:
    secret = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6
    return {
        "assign": kept(located(text, ASSIGN, text.rlike(ASSIGN)), secret),
        "access": located(text, ACCESS, text.contains("AKIA")),
        "hex": located(text, HEX, text.rlike(HEX)),
    }


def uncovered(candidate: Column, spans: Column) -> Column:
    """The parts of a candidate that no span covers, as structs of start and end."""
    def parts(near: Column) -> Column:
        starts = F.array_distinct(F.concat(F.array(candidate["start"]), F.transform(near, lambda b: b["end"])))
        free = F.filter(starts, lambda s: (s < candidate["end"]) & ~F.exists(near, lambda b: (b["start"] <= s) & (s < b["end"])))
        return F.transform(free, lambda s: F.struct(s.alias("start"), F.array_min(F.concat(F.array(candidate["end"]), F.filter(
            F.transform(near, lambda b: b["start"]), lambda begin: begin > s))).alias("end")))

    return once(F.filter(spans, lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"])), parts)


def scanned(docs: DataFrame, text: str = "text", window: int = WINDOW, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """`docs` with the columns of base spans by kind, `base` and `all_spans` (sorted by start) in a struct `secrets`."""
    content = text_column(text)
    found = base_spans(content)
    base = F.concat(*[named(found[kind], kind, i) for i, kind in enumerate(KINDS)])
    candidates = located(content, CANDIDATE, content.rlike(CANDIDATE))
    step = docs.withColumn("secrets", F.struct(base.alias("base"), candidates.alias("candidates")))
    spans, strings = F.col("secrets.base"), F.col("secrets.candidates")
    random = F.filter(strings, lambda c: random_looking(c["found"], window, allowed))
    added = F.flatten(F.transform(random, lambda c: uncovered(c, spans)))
    return step.withColumn("secrets", F.struct(
        by_start(spans).alias("base"), by_start(F.concat(spans, named(added, "entropy", len(KINDS)))).alias("all_spans")))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (fixed forms), base_sha256, spans and n_entropy (added ones) of each row."""
    spans = scanned(docs.select("doc_id", "text"))
    base, everything = F.col("secrets.base"), F.col("secrets.all_spans")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS], F.sha2(written(base), 256).alias("base_sha256"),
        written(everything).alias("spans"), (F.size(everything) - F.size(base)).cast("long").alias("n_entropy"))


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """`docs` with the text of all spans replaced by a mark; overlapping spans become one. A null text stays null."""
    rows, at = numbered(docs)
    found, content = scanned(rows, at["text"]), F.col(at["text"])

    def pieces(letters: Column) -> Column:
        between = lambda begin, end: F.array_join(F.slice(letters, begin + 1, end - begin), "")
        spans = F.col("secrets.all_spans")
        ends = F.transform(spans, lambda s: s["end"])
        reached = before_each(ends, lambda a, b: F.greatest(a, b))
        edges = F.zip_with(spans, reached, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        fresh = F.filter(edges, lambda e: e["start"] >= e["at"])
        kept_text = F.transform(fresh, lambda e: F.concat(between(e["at"], e["start"]), F.lit(mark)))
        return F.array_join(F.concat(kept_text, F.array(between(F.array_max(ends), F.size(letters)))), "")

    clean = once(F.split(content, ""), pieces)
    text = F.when(F.size("secrets.all_spans") > 0, clean).otherwise(content)
    return found.select(*[(text if c == "text" else F.col(at[c])).alias(c) for c in docs.columns])
