"""Personal data in texts: four fixed forms, and identifiers found by bootstrapped contexts.

Everything is a column expression, a join or an aggregate.

1. The fixed forms (email, ip, card, phone) are the seed entities.
2. Strings that carry a digit or an at sign are instances. The word before an occurrence, the word after it and both
   together are its lexical patterns. Patterns and instances form a graph.
   Strings of a fixed form that fail its check (a card without a valid check digit) are seeds of a kind of their own, which
   is never reported and speaks against their contexts.
3. Scores run over the graph for some rounds. A pattern's confidence for a kind is the mean score of its distinct
   instances; it counts with at least `support` seeds' worth of score. An instance's score is 1 if it is a seed of the kind, 0
   if it is one of another kind, else 1 - prod(1 - confidence) over its patterns.
4. Unlabelled instances that reach `accept` are unseen identifiers; all their occurrences that overlap no fixed form are added.

Graph nodes are distinct patterns and strings, so frequent words cost no more than their distinct neighbours; all sums are
combined before the shuffle, and a hot pattern meets its edges in a join with one row of its own.

Defined results: a null or empty text has no spans; rows of equal id and text have equal spans; rows are told apart by
id and text, null ids included; an empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import stored, text_column
from fareloom.llm.spans import by_kind, kept, located, named, once, written

# The forms of the base scan. Possessive parts and conditions on the character before only save
# time: they match the same strings.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?=[0-9\x20-]{13})[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
CONTEXT = 80  # characters next to an instance in which its neighbour word is looked for; a longer word counts by these alone


def valid_ip(found: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    small = lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(found, r"\."), small)


def valid_card(found: Column) -> Column:
    digits = F.reverse(F.regexp_replace(found, r"[\x20-]", ""))
    digit = lambda i: F.ascii(F.substring(digits, i, F.lit(1))) - 48
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0),
                        lambda s, i: s + F.when(i % 2 == 0, doubled(digit(i))).otherwise(digit(i)))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def valid_phone(found: Column) -> Column:
    return F.length(F.regexp_replace(found, "[^0-9]", "")).between(9, 15)


def base_spans(text: Column) -> dict[str, Column]:
    digit = text.rlike("[0-9]")
    return {
        "email": located(text, EMAIL, text.contains("@")),
        "ip": kept(located(text, IP, digit), valid_ip),
        "card": kept(located(text, CARD, digit), valid_card),
        "phone": kept(located(text, PHONE, text.contains("+")), valid_phone),
    }


REFUSED = "-"


def label(found: Column) -> Column:
    """The kind whose form a string carries; REFUSED if it has the form of one and fails its check; else null."""
    whole = lambda pattern: F.regexp_extract(found, pattern, 0)
    shaped = {"ip": (IP, valid_ip), "card": (CARD, valid_card), "phone": (PHONE, valid_phone)}
    kind = F.when(whole(EMAIL) != "", "email")
    for name, (pattern, valid) in shaped.items():
        kind = kind.when((whole(pattern) != "") & valid(whole(pattern)), name)
    for pattern, _ in shaped.values():
        kind = kind.when(whole(pattern) != "", REFUSED)
    return kind


# Instances: phone and card forms first, which may hold blanks, then any string with a digit or an at sign.
INSTANCE = rf"{PHONE}|{CARD}|{TOKEN}"


def instances(text: Column) -> Column:
    """start, end, found and the words before and after each instance of a text."""
    whole = located(text, INSTANCE, text.rlike("[0-9@]"))
    bare = lambda found: F.regexp_replace(found, r"[.,;:!?)\]]+$", "")
    spans = F.transform(whole, lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + F.length(bare(s["found"]))).alias("end"), bare(s["found"]).alias("found")))
    word = lambda part, pattern: F.lower(F.regexp_replace(F.regexp_extract(part, pattern, 1), r"[^\p{L}\p{N}:=#]", ""))
    before = lambda c, s: F.slice(c, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
    after = lambda c, s: F.slice(c, s["end"] + 1, F.lit(CONTEXT))

    def described(both: Column) -> Column:  # the text by characters, so that a place in it costs nothing to reach
        return F.transform(both["spans"], lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
            word(F.array_join(before(both["letters"], s), ""), r"(\S+)\s*$").alias("left"),
            word(F.array_join(after(both["letters"], s), ""), r"^\s*(\S+)").alias("right")))

    letters = F.when(text.rlike("[0-9@]"), F.split(text, "")).otherwise(F.array().cast("array<string>"))
    return once(F.struct(spans.alias("spans"), letters.alias("letters")), described)


def scored_instances(occurrences: DataFrame, rounds: int, support: float, accept: float) -> DataFrame:
    """instance and kind of the unlabelled strings that reach `accept`."""
    left, right = F.col("left"), F.col("right")
    words = F.array(F.when(left != "", F.concat(left, F.lit(" _"))), F.when(right != "", F.concat(F.lit("_ "), right)),
                    F.when((left != "") & (right != ""), F.concat(left, F.lit(" _ "), right)))
    edges = stored(
        occurrences.select(F.explode(F.array_compact(words)).alias("pattern"), F.col("found").alias("instance"), "label").distinct(), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    seeds = edges.where("label IS NOT NULL").select("instance", F.col("label").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores = seeds
    for _ in range(rounds):
        confident = (
            edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("held"))
            .where(F.col("held") >= support).join(sizes, "pattern")
            .select("pattern", "kind", F.least(F.col("held") / F.col("size"), F.lit(0.999)).alias("confidence"))
        )
        found = (
            edges.where("label IS NULL").join(confident, "pattern").groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
        )
        scores = stored(seeds.unionByName(found), "pii-scores")
    known = edges.where("label IS NOT NULL").select("instance").distinct()
    return scores.where(F.col("score") >= accept).join(known, "instance", "left_anti").groupBy("instance").agg(
        F.max_by("kind", F.struct("score", "kind")).alias("kind")).where(F.col("kind") != REFUSED)


def personal_data(docs: DataFrame, rounds: int = 3, support: float = 5.0, accept: float = 0.9) -> DataFrame:
    """doc_id, base (fixed forms) and all_spans (with those found by context), sorted by kind and start, of each row."""
    text = text_column()
    found = base_spans(text)
    scan = stored(docs.select(
        "doc_id", F.xxhash64(text).alias("text_key"), F.concat(*[named(found[k], k, i) for i, k in enumerate(KINDS)]).alias("base"),
        instances(text).alias("instances")), "pii-scan")
    seen = scan.where(F.size("instances") > 0).select("doc_id", "text_key", "base", F.explode("instances").alias("i")) \
        .select("doc_id", "text_key", "base", "i.*").withColumn("label", label(F.col("found")))
    unseen = scored_instances(seen.select("left", "right", "found", "label"), rounds, support, accept)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    added = (
        seen.where("label IS NULL").join(unseen.withColumnRenamed("instance", "found"), "found")
        .where(~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"])))
        .groupBy(F.col("doc_id").alias("a_id"), F.col("text_key").alias("a_key"))
        .agg(F.collect_set(F.struct(rank.alias("rank"), "start", "end", "kind")).alias("added"))
    )
    joined = scan.join(added, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_key") == F.col("a_key")), "left")
    kind = "array<struct<rank:int,start:int,end:int,kind:string>>"
    everything = F.concat(F.col("base").cast(kind), F.coalesce(F.col("added").cast(kind), F.array().cast(kind)))
    return joined.select("doc_id", by_kind(F.col("base")).alias("base"), by_kind(everything).alias("all_spans"))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (fixed forms), base_sha256, spans and n_added of each row."""
    spans = personal_data(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("all_spans")).alias("spans"), (F.size("all_spans") - F.size("base")).cast("long").alias("n_added"))
