"""Quality rules kept as a ledger of failure bits (native).

Every rule is evaluated once per row. The ledger stores the measurements and one bit per failed
rule; a policy is a set of rules, so a new version or an ablation reads the ledger only.

Defined cases: a missing or empty text has no words and fails ``few_words``; rows are judged one by
one, so repeated rows, missing ids and further columns pass through unchanged. Columns of the input
that share a name with a measurement are replaced by it in the ledger; ``kept`` returns them as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, words

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A row fails the rule where ``fails`` (SQL over the measurements) is true."""

    name: str
    bit: int
    fails: str


#: A bit number is never given to another rule, so stored ledgers stay readable.
RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 25 * n_words"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
)
BASE = ("few_words", "repeated_words")
#: Versions of the policy: the rules that make a row go.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines", "short_words", "long_words"),
}
CURRENT = "v1"


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << rule.bit for rule in RULES if rule.name in names)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements of one text column.

    Repeated three-word windows are found by sorting, inside the row, (hash, place) pairs: equal
    windows become neighbours that know their places. Neighbours are compared by their words, not
    only by the hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda array: F.size(array).cast("long")
    out = df.withColumn("_w", words(F.col(text))).withColumn(
        "_l", F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    out = out.withColumns(
        {
            "n_words": count("_w"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_lines": count("_l"),
            "n_dup_lines": count("_l") - count(F.array_distinct("_l")),
        }
    )
    out = out.withColumn(
        "_g",
        F.expr(
            "if(n_words < 3, array(), transform(sequence(0, size(_w) - 3), i ->"
            " xxhash64(_w[i], _w[i + 1], _w[i + 2])))"
        ),
    )
    out = out.withColumn(  # most texts repeat no window and need no sort
        "_k",
        F.expr(
            "if(size(array_distinct(_g)) = size(_g), array(),"
            " sort_array(transform(_g, (h, i) -> struct(h, i))))"
        ),
    )
    same = "get(_k, {j}).h = x.h" + "".join(f" and _w[get(_k, {{j}}).i + {d}] = _w[x.i + {d}]" for d in range(3))
    out = out.withColumn(
        "_p",
        F.expr(
            f"sort_array(transform(filter(_k, (x, j) -> coalesce({same.format(j='j - 1')}, false)"
            f" or coalesce({same.format(j='j + 1')}, false)), x -> x.i))"
        ),
    )
    out = out.withColumn(
        "n_repeat_words",
        F.expr("aggregate(transform(_p, (x, j) -> least(3, coalesce(get(_p, j + 1) - x, 3))), 0L, (a, x) -> a + x)"),
    )
    return out.drop("_w", "_l", "_g", "_k", "_p")


def failure_bits() -> Column:
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long") for rule in RULES
    ]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements and ``fail_bits``.

    They come out of a one-element ``inline``, as a filter on them must not move below: it would
    be put in terms of the text and repeat the work for every use of an array.
    """
    entry = F.inline(F.array(F.struct(*MEASURES, failure_bits().alias("fail_bits"))))
    found = measured(df, text)
    return found.select(*[c for c in found.columns if c not in (*MEASURES, "fail_bits")], entry)


def passes(names: tuple[str, ...]) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(names))) == 0


def kept(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their own columns, however these are named."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    return ledger(rows, "_text").where(passes(POLICIES[policy])).select("_row.*")


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, measurements, failure bits) of every row, written once: policies and ablations read it."""
    return staged(ledger(docs.select(F.col(id_col), F.col(text).alias("_text")), "_text").drop("_text"), "quality-ledger")


def ablation(entries: DataFrame, policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per policy and rule: rows kept now, rows that fail the rule, rows that only this rule removes.

    The ledger is first counted per bit pattern, of which there are 2**rules at most; everything
    else is bit arithmetic on those few rows.
    """
    policies = policies or POLICIES
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    named = [(p, r.name, mask(names), 1 << r.bit) for p, names in policies.items() for r in RULES if r.name in names]
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("m"), F.lit(b).alias("b")
                )
                for p, r, m, b in named
            ]
        )
    )
    rows = patterns.select("fail_bits", "n", cells.alias("c")).select("fail_bits", "n", "c.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("m"))
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return rows.groupBy("policy", "rule").agg(
        total(hit == 0).alias("kept"),
        total(F.col("fail_bits").bitwiseAND(F.col("b")) != 0).alias("failing"),
        total(hit == F.col("b")).alias("only_this_rule"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(POLICIES["base"])).alias("base_failed"),
        passes(POLICIES[CURRENT]).alias("kept"),
        "fail_bits",
    )


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy costs, from the stored ledger of all documents."""
    return ablation(stored_ledger(table(spark, sf_dir, "documents")))


LEDGER_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS rid FROM documents
), split AS (
  SELECT rid, doc_id, body,
         list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
), measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)
), bits AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits
  FROM measures
)
"""

QUALITY_SQL = LEDGER_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM bits
"""

_POLICY_RULES = ", ".join(
    f"('{policy}', '{rule.name}', {mask(names)}, {1 << rule.bit})"
    for policy, names in POLICIES.items()
    for rule in RULES
    if rule.name in names
)
ABLATION_SQL = LEDGER_SQL + f"""
SELECT policy, rule, count(*) FILTER (fail_bits & m = 0) AS kept, count(*) FILTER (fail_bits & b <> 0) AS failing,
       count(*) FILTER (fail_bits & m = b) AS only_this_rule
FROM bits, (VALUES {_POLICY_RULES}) AS rules(policy, rule, m, b)
GROUP BY policy, rule
"""

QUERIES = {"op5_quality_rules": op5_quality_rules, "quality_ablation": quality_ablation}
ORACLES = {"op5_quality_rules": QUALITY_SQL, "quality_ablation": ABLATION_SQL}
