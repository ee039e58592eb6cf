"""Personal data: base patterns, and bootstrapped contextual extraction of what they miss.

Everything runs as DataFrame functions. The base patterns give the seed entities. A
candidate is a word of the text that holds ``min_digits`` digits or an @ and lies
outside every base span; its context is the two words before it, lower-cased, with
digits masked. Patterns (contexts) and instances (the texts that follow them) form a graph:

* a pattern's score for a kind is the weighted share of its instances that are
  known to be of that kind, shrunk by ``shrink`` unknown ones;
* an instance's score for a kind is 1 if it is a seed, else one minus the product
  of (1 - score) over the patterns it occurs with.

Both are computed in turns for ``rounds`` rounds over counts per pattern and
instance. Patterns of at least ``min_support`` different seed instances whose score
reaches ``threshold`` then label the candidates that follow them: those are the
added spans. Base spans always stay.

Matching is leftmost and non-overlapping per kind, as the stated patterns read;
possessive forms and look-behinds only keep it linear in the length of a text.

Defined cases: null texts count as empty; ids may be null or repeat (rows are
handled each, and repeated rows get equal results); without seeds nothing is
added; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import row_key, stored

KINDS = ("email", "ip", "card", "phone")
#: The stated patterns, written so that no text takes more than linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: What a text must hold for a kind to be looked for.
HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}

MIN_DIGITS, ROUNDS, THRESHOLD, MIN_SUPPORT, SHRINK = 4, 3, 0.8, 3, 1.0


def _luhn(digits: Column) -> Column:
    """Sum over digits from the right, every second one doubled, divisible by 10."""
    one = lambda x: F.ascii(x) - 48
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda x, i: F.when(i % 2 == 1, twice(one(x))).otherwise(one(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _valid_only(kind: str, found: Column) -> Column:
    return F.filter(found, lambda m: _valid(kind, m["v"]))


def _labelled(order: int, kind: str) -> Column:
    """The spans of one kind as (order, kind, s, e, value)."""
    return F.transform(F.col(kind), lambda m: F.struct(F.lit(order).alias("order"), F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("value")))


def _matches(text: Column, pattern: str) -> Column:
    """All matches as an array of (s, e, v) in code points: the pieces between them tell where they begin."""
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.lit(None).cast("array<struct<s:int,e:int,v:string>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array().cast("array<struct<s:int,e:int,v:string>>")).alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["p"])
        end = begin + F.length(x["v"])
        return F.struct(end.alias("at"), F.array_append(a["out"], F.struct(begin.alias("s"), end.alias("e"), x["v"].alias("v"))).alias("out"))

    # The piece after the last match has no value beside it.
    both = F.zip_with(F.slice(pieces, 1, F.size(values)), values, lambda p, v: F.struct(p.alias("p"), v.alias("v")))
    return F.aggregate(both, start, step, lambda a: a["out"])


def base_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, text, email, ip, card, phone): base spans of every text, each an array of (s, e, v)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    for kind, pattern in PATTERNS.items():
        hint = F.contains("text", F.lit(HINT[kind])) if HINT[kind] else F.lit(True)
        if kind in ("ip", "card"):
            hint = hint & F.col("text").rlike("[0-9]")
        found = F.when(hint, _matches(F.col("text"), pattern)).otherwise(none)
        rows = rows.withColumn(kind, _valid_only(kind, found))
    return rows


#: A word that holds a digit or an @.
WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


def _masked(x: Column) -> Column:
    """Lower case, digits as 0: the lexical form of a context word."""
    return F.regexp_replace(F.lower(x), "[0-9]", "0")


def occurrences(entities: DataFrame, min_digits: int = MIN_DIGITS) -> DataFrame:
    """(doc_id, key, seen): per row its entities and its candidates (kind null), as (order, kind, s, e, value, pattern)."""
    base = F.concat(*[_labelled(i, k) for i, k in enumerate(KINDS)])
    rows = entities.withColumn("key", row_key("doc_id", "text")).withColumn("base", base)
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    words = F.when(F.col("text").rlike("[0-9@]"), _matches(F.col("text"), WORD)).otherwise(none)
    rows = rows.withColumn("words", words)
    wanted = lambda w: w["v"].contains("@") | (F.length(F.regexp_replace(w["v"], "[^0-9]", "")) >= min_digits)
    outside = F.filter("words", lambda w: wanted(w) & ~F.exists("base", lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"])))
    # Brackets, quotes and marks around the word are not part of it.
    lead = lambda w: F.length(F.regexp_extract(w["v"], r"^[^\p{L}0-9+]*+", 0))
    core = lambda w: F.regexp_extract(w["v"], r"^[^\p{L}0-9+]*+(.*[\p{L}0-9])", 1)
    bare = F.transform(outside, lambda w: F.struct(
        F.lit(None).cast("int").alias("order"), F.lit(None).cast("string").alias("kind"),
        (w["s"] + lead(w)).alias("s"), (w["s"] + lead(w) + F.length(core(w))).alias("e"), core(w).alias("value"),
    ))
    rows = rows.withColumn("every", F.concat("base", F.filter(bare, lambda w: w["e"] > w["s"])))
    left = lambda o: F.substring(F.col("text"), F.greatest(o["s"] - 79, F.lit(1)), F.least(o["s"], F.lit(80)))
    context = lambda o: F.regexp_extract(left(o), r"(\S+\s+\S+\s+)[^\p{L}0-9\s]*$", 1)
    seen = F.transform("every", lambda o: F.struct(
        o["order"].alias("order"), o["kind"].alias("kind"), o["s"].alias("s"), o["e"].alias("e"), o["value"].alias("value"),
        _masked(F.regexp_replace(context(o), r"\s+", " ")).alias("pattern"),
    ))
    return rows.select("doc_id", "key", seen.alias("seen"))


def score_patterns(seen: DataFrame, rounds: int = ROUNDS, shrink: float = SHRINK) -> DataFrame:
    """(pattern, kind, score, support): how sure a pattern names a kind, after ``rounds`` turns over the graph."""
    edges = seen.groupBy("pattern", "value").agg(F.max("kind").alias("kind"), F.count("*").alias("n"))
    # Only patterns that a seed has been seen with can score; the others carry no edge further.
    live = edges.filter("kind IS NOT NULL").select("pattern").distinct()
    edges = stored(edges.join(live, "pattern", "left_semi"), "edges")
    seeds = edges.filter("kind IS NOT NULL").select("value", "kind").distinct().withColumn("known", F.lit(1.0))
    support = edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("support"))
    total = edges.groupBy("pattern").agg(F.sum(F.log1p("n")).alias("total"))
    known = seeds
    scores = None
    for turn in range(rounds):
        if turn:
            risen = edges.select("pattern", "value").join(scores, "pattern")
            risen = risen.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("known"))
            known = risen.join(seeds.select("value", F.lit(True).alias("seed")).distinct(), "value", "left").filter("seed IS NULL").select("value", "kind", "known").union(seeds)
        weight = edges.select("pattern", "value", F.log1p("n").alias("w")).join(known, "value")
        hit = weight.groupBy("pattern", "kind").agg(F.sum(F.col("w") * F.col("known")).alias("hit"))
        scores = stored(hit.join(total, "pattern").select("pattern", "kind", (F.col("hit") / (F.col("total") + shrink)).alias("score")), "scores")
    return scores.join(support, ["pattern", "kind"])


def contextual_spans(seen: DataFrame, scores: DataFrame, threshold: float = THRESHOLD, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(key, kind, s, e, score): candidates that follow a pattern of high confidence."""
    sure = scores.filter((F.col("score") >= threshold) & (F.col("support") >= min_support))
    best = sure.groupBy("pattern").agg(F.max(F.struct("score", "support", "kind")).alias("b")).select("pattern", "b.kind", "b.score")
    return seen.filter("kind IS NULL").select("key", "s", "e", "pattern").join(best, "pattern").select("key", "kind", "s", "e", "score")


def personal_data(docs: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(doc_id, key, base, added): base spans of each row as (kind, s, e), and those added by context.

    Runs the pattern scoring at once; the result is lazy.
    """
    rows = stored(occurrences(base_entities(docs)), "occurrences")
    seen = rows.select("key", F.explode("seen").alias("o")).select("key", "o.*").filter(F.length("pattern") > 0)
    added = contextual_spans(seen, score_patterns(seen, rounds), threshold, min_support)
    order = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind"))
    added = added.groupBy("key").agg(F.collect_set(F.struct(order.alias("order"), "kind", "s", "e")).alias("added"))
    plain = lambda o: F.struct(o["order"].alias("order"), o["kind"].alias("kind"), o["s"].alias("s"), o["e"].alias("e"))
    base = F.transform(F.filter("seen", lambda o: o["kind"].isNotNull()), plain)
    rows = rows.select("doc_id", "key", base.alias("base")).join(added, "key", "left")
    return rows.withColumn("added", F.array_sort(F.coalesce("added", F.array().cast(rows.schema["base"].dataType))))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
