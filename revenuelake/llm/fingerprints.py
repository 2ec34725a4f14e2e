"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

For sample s every term k has fixed random numbers r, c ~ Gamma(2, 1) and b ~ U(0, 1), made from hashes. With weight
w: t = floor(ln w / r + b), ln a = ln c - r (t - b + 1). The sample is (k, t) of the term with the least a. Two
weighted sets agree on a sample with the probability of their generalised Jaccard similarity, the sum of the
lesser weights by the sum of the greater ones.

``signatures`` samples any table of terms with weights. Documents are taken as their words, the weight of each its
count in the text times its number of characters, so that repeats count, and rare, long words more than short common
ones. A word with the same weight in both texts is drawn once for both. A fingerprint has four hex digits for each of
the samples.

Samples are drawn in expressions of generated code; a term row is repeated for a few lanes, each of which draws
``PER_LANE`` samples, which keeps the generated methods small. Documents are joined to their successors by keys; the order
of ids comes from a range-partitioned numbering of ids without texts.

Defined results: a null text is empty; a text without words is one term, itself; documents follow the id (null
first), then the hash of the text; the last one's successor is the first, a single document's is itself; repeated
rows are one place in that order, and each gets the result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import whole_text
from revenuelake.operators.skew import global_row_number
from revenuelake.session import materialize

LANES = 4
PER_LANE = 8
DIGITS = 4
SIDES = ("text", "edited")
NO_ID = -(1 << 63)
_LOW = (1 << 32) - 1


def samples() -> int:
    return LANES * PER_LANE


def _bits(h: Column, start: int, width: int) -> Column:
    """A number in (0, 1) from some bits of a hash."""
    part = F.shiftrightunsigned(h, start).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 0.5) * (2.0**-width)


def drawn(term: Column, weight_log: Column, lane: Column, at: int) -> Column:
    """Sample ``at`` of a lane for one term: ln a in the high bits, the mark of (term, t) in the low 32."""
    one, two = F.xxhash64(term, lane, F.lit(2 * at)), F.xxhash64(term, lane, F.lit(2 * at + 1))
    r = -F.ln(_bits(one, 0, 32) * _bits(one, 32, 32))
    log_c = F.ln(-F.ln(_bits(two, 0, 24) * _bits(two, 24, 24)))
    b = _bits(two, 48, 16)
    t = F.floor(weight_log / r + b)
    log_a = log_c - r * (t - b + 1)
    rank = ((log_a + 100.0) * float(1 << 24)).cast("long")
    return F.shiftleft(rank, 32).bitwiseOR(F.xxhash64(term, t).bitwiseAND(F.lit(_LOW)))


def signatures(terms: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints of weighted terms: keys and one column for each side.

    ``terms`` has the keys, ``term`` (long), ``weight`` (double) and ``sides``, whose bits say which of the key's two
    texts hold the term with this weight.
    """
    spread = terms.select(
        *keys, "term", "sides", F.ln("weight").alias("_w"), F.explode(F.array(*map(F.lit, range(LANES)))).alias("lane")
    )
    marks = spread.select(
        *keys, "lane", "sides", *[drawn(F.col("term"), F.col("_w"), F.col("lane"), i).alias(f"_{i}") for i in range(PER_LANE)]
    )
    least = marks.groupBy(*keys, "lane").agg(
        *[
            F.min(F.when(F.col("sides").bitwiseAND(F.lit(1 << side)) != 0, F.col(f"_{i}"))).alias(f"_{side}_{i}")
            for side in range(len(SIDES))
            for i in range(PER_LANE)
        ]
    )

    def digits(side: int) -> Column:
        each = [F.lpad(F.lower(F.hex(F.col(f"_{side}_{i}").bitwiseAND(F.lit((1 << 4 * DIGITS) - 1)))), DIGITS, "0") for i in range(PER_LANE)]
        return F.concat(*each)

    lanes = least.select(*keys, F.struct("lane", *[digits(s).alias(name) for s, name in enumerate(SIDES)]).alias("_l"))
    joined = lanes.groupBy(*keys).agg(F.sort_array(F.collect_list("_l")).alias("_l"))
    return joined.select(*keys, *[F.array_join(F.col(f"_l.{name}"), "").alias(name) for name in SIDES])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints."""
    def equal(i: Column) -> Column:
        return F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS))

    return F.size(F.filter(F.sequence(F.lit(0), F.lit(samples() - 1)), equal)) / F.lit(float(samples()))


def words(text: Column) -> Column:
    """The words of a text, repeats too; a text without words is one term, itself."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.when(F.size(found) > 0, found).otherwise(F.array(text))


def weighted_terms(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, word, n and sides: how often each word occurs in text (1), in edited (2), or alike in both (3)."""
    both = F.array(*[F.struct(F.lit(1 << s).alias("sides"), words(F.col(name)).alias("words")) for s, name in enumerate(SIDES)])
    each = pairs.select(*keys, F.explode_outer(both).alias("_s")).select(*keys, "_s.sides", F.explode_outer("_s.words").alias("word"))
    counts = each.groupBy(*keys, "word").agg(*[F.count_if(F.col("sides") == 1 << s).alias(f"_n{s}") for s in range(len(SIDES))])
    apart = F.array(*[F.struct(F.col(f"_n{s}").alias("n"), F.lit(1 << s).alias("sides")) for s in range(len(SIDES))])
    alike = F.array(F.struct(F.col("_n0").alias("n"), F.lit(3).alias("sides")))
    rows = counts.select(*keys, "word", F.explode(F.when(F.col("_n0") == F.col("_n1"), alike).otherwise(apart)).alias("_t"))
    return rows.select(*keys, "word", "_t.n", "_t.sides").where(F.col("n") > 0)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the key (k, h) of a row and its whole text."""
    text = whole_text()
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text"))


def successors(rows: DataFrame) -> DataFrame:
    """k, h and the key (next_k, next_h) of the next document; n_chars of the document itself."""
    ids = rows.groupBy("k", "h").agg(F.max(F.char_length("text")).alias("n_chars"))
    numbered = global_row_number(ids, [F.col("k"), F.col("h")], "place")
    numbered = materialize(numbered, "fingerprint-order")
    total = numbered.agg(F.count(F.lit(1)).alias("total"))  # one row
    after = numbered.select(F.col("place").alias("_p"), F.col("k").alias("next_k"), F.col("h").alias("next_h"))
    wanted = numbered.crossJoin(F.broadcast(total)).withColumn("_p", F.col("place") % F.col("total") + 1)
    return wanted.join(after, "_p").select("k", "h", "n_chars", "next_k", "next_h")


def edited_pairs(rows: DataFrame, order: DataFrame) -> DataFrame:
    """k, h, text and edited text of each distinct document row."""
    one = rows.select("k", "h", "text")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = order.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), cut.alias("cut"))
    heads = one.join(wanted, ["k", "h"]).select("to_k", "to_h", "cut", F.left("text", F.col("cut")).alias("head"))
    heads = heads.groupBy(F.col("to_k").alias("k"), F.col("to_h").alias("h")).agg(F.max("head").alias("head"), F.max("cut").alias("cut"))
    joined = one.join(heads, ["k", "h"])
    kept = F.left("text", F.char_length("text") - F.col("cut"))
    return joined.select("k", "h", "text", F.concat(kept, F.col("head")).alias("edited"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next; one row for each document."""
    rows = keyed(docs)
    order = materialize(successors(rows), "fingerprint-successors")
    pairs = edited_pairs(rows, order)
    keys = ["k", "h", "n_chars", "edited_sha256"]
    listed = pairs.select(
        "k", "h", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), *SIDES
    )
    counted = weighted_terms(listed, keys)
    weight = F.col("n") * F.greatest(F.char_length("word"), F.lit(1)).cast("double")
    terms = counted.select(*keys, "sides", F.xxhash64("word").alias("term"), weight.alias("weight"))
    prints = materialize(signatures(terms, keys), "fingerprints")
    after = prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("text").alias("next_text"))
    beside = prints.join(order.select("k", "h", "next_k", "next_h"), ["k", "h"]).join(after, ["next_k", "next_h"])
    shown = beside.select(
        "k", "h", "n_chars", "edited_sha256", F.col("text").alias("fingerprint"), F.col("edited").alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"), likeness(F.col("text"), F.col("next_text")).alias("near_next"),
    )
    return rows.select("doc_id", "k", "h").join(shown, ["k", "h"]).drop("k", "h")
