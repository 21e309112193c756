"""Quality rules as a bitmask ledger, with DataFrame functions alone.

Every rule is evaluated once on a document; its failure is a bit and what it measured is a column.
Which documents stay is then a question to the ledger: a policy is a version and a mask of rules,
a document passes if no bit of the mask is set, and what each rule alone costs a policy is counted
from the bits without touching a text again.

Nulls: a null text has no words and fails as an empty one does. A very long text is measured whole. Rows are independent, so that ties,
repeated rows and columns of other names change nothing (those with the names of added ones give way); an
empty table gives an empty result.
All work on a document is in the order n log n of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 5


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and n_capitals.

    Words are ``[^\\x20\\x09-\\x0D]+``, characters are code points. A line counts if it has a word; it is a
    duplicate if an earlier line equals it. A word is repeated if a window of five words that holds it
    stands in the text twice or more.
    """
    w = WINDOW
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "failed")
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_words", F.filter(F.split("_text", "[ \\t-\\r]+", -1), lambda x: x != ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    hashes = F.when(
        F.col("n_words") >= w,
        F.transform(F.sequence(F.lit(0), (F.col("n_words") - w).cast("int")), lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(w)])),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(none))
    twice = F.filter("_sorted", lambda x, i: (F.get(F.col("_sorted"), i - 1)["h"] == x["h"]) | (F.get(F.col("_sorted"), i + 1)["h"] == x["h"]))
    df = df.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(w), F.get(F.col("_at"), i + 1) - p)), F.lit(0).cast("long"), lambda total, n: total + n
    )
    return df.select(
        *docs.columns,
        "n_words",
        F.aggregate("_words", F.lit(0).cast("long"), lambda total, x: total + F.length(x)).alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )


def rules() -> dict[str, Column]:
    """Failures by name; the order gives the bits. Ratios are compared in whole numbers."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeated_windows": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
        "repeated_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "capitals": 2 * F.col("n_capitals") > F.col("word_chars"),
    }


BITS = {name: 1 << i for i, name in enumerate(("few_words", "repeated_windows", "symbols", "word_length", "repeated_lines", "capitals"))}
BASE = BITS["few_words"] | BITS["repeated_windows"]
POLICIES = {"base": BASE, "v1": BASE | BITS["symbols"] | BITS["repeated_lines"], "v2": sum(BITS.values())}


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements and ``failed``, a bit for each rule."""
    bits = [F.when(failed, F.lit(BITS[name])).otherwise(0) for name, failed in rules().items()]
    return measure(docs, text).withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def passes(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: documents it fails, fails alone, and those kept without it; one aggregation over the bits."""
    mask = POLICIES[policy]
    names = [name for name, bit in BITS.items() if bit & mask]
    hit = F.col("failed").bitwiseAND(F.lit(mask))
    sums = book.agg(
        F.count(F.when(hit == 0, 1)).alias("kept"),
        *[F.count(F.when(hit.bitwiseAND(F.lit(BITS[n])) != 0, 1)).alias(f"{n}_failed") for n in names],
        *[F.count(F.when(hit == BITS[n], 1)).alias(f"{n}_alone") for n in names],
    )
    row = lambda n: F.struct(F.lit(n).alias("rule"), F.col(f"{n}_failed").alias("failed"), F.col(f"{n}_alone").alias("failed_alone"), (F.col("kept") + F.col(f"{n}_alone")).alias("kept_without"))
    return sums.select(F.inline(F.array(*[row(n) for n in names])))


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes("base")).alias("base_failed"), passes("v2").alias("kept"), "failed"
    )


OP8_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS g FROM w, unnest(range(1, len(words) - 3)) u(i) WHERE len(words) >= 5),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, range(5) r(k) GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals
      FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
                 + 8 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::BIGINT + 16 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
                 + 32 * (2 * n_capitals > word_chars)::BIGINT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""
