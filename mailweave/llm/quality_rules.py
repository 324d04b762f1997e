"""Quality rules as a ledger of bits: measure once, decide as often as wanted.

``rule_ledger`` evaluates every rule once per document and stores a bit for each failed rule
beside the measurements. Policies are versioned sets of rules, that is bit masks, so applying
another policy, or asking what a policy would keep without one of its rules, reads bits and
never a text again.

All of it is SQL expressions within a row; nothing is shuffled. Windows of five words are
compared by a 64-bit hash within one document.

Edge cases: a null or empty text has no words, fails ``few_words`` and is not kept. Repeated
rows are measured each for itself. Extra columns of any name are not read or returned, except
those named in ``keep``. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import words

WINDOW = 5
# Which characters count as symbols, and the end of punctuation-only words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

# Rule -> condition over the measurements under which a document fails. A rule's bit is its
# place in this table, so new rules go to the end.
RULES = {
    "few_words": "n_words < 10",
    "repeat_words": "100 * n_repeat_words > 20 * n_words",
    "symbol_words": "4 * n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "5 * n_upper > 3 * (n_upper + n_lower)",
    "exclaiming": "5 * n_exclaims > n_words",
}
# Version -> the rules that decide.
POLICIES = {
    1: ["few_words", "repeat_words"],
    2: [*RULES],
}
POLICY = 2


def mask(rules: list[str]) -> int:
    """The bits of the named rules."""
    names = [*RULES]
    return sum(1 << names.index(rule) for rule in rules)


def repeated_words(w: str, hashes: str, repeated: str) -> Column:
    """Words inside windows of five that the text holds more than once."""
    return F.expr(
        f"""aggregate(transform({repeated}, (p, k) ->
              least({WINDOW}, coalesce(get({repeated}, k + 1) - p, {WINDOW}))), 0L, (a, x) -> a + x)"""
    )


def measure(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the measurements of every text."""
    keep = ["doc_id"] if keep is None else keep
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        *[F.col(f"`{c}`") for c in keep],
        t.alias("_t"),
        words(t).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("_lines"),
    )
    # One hash per word, then one per window.
    rows = rows.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    window = ", ".join(f"_h[i + {k}]" for k in range(WINDOW))
    rows = rows.withColumn(
        "_g",
        F.expr(
            f"""CASE WHEN size(_h) >= {WINDOW} THEN transform(sequence(0, size(_h) - {WINDOW}),
                i -> xxhash64({window})) ELSE array() END"""
        ).cast("array<bigint>"),
    )
    # Most texts repeat nothing, which a hash set tells; only the others are sorted.
    rows = rows.withColumn(
        "_s",
        F.expr(
            """CASE WHEN size(array_distinct(_g)) < size(_g)
               THEN sort_array(transform(_g, (h, i) -> struct(h, i))) END"""
        ),
    )
    rows = rows.withColumn(
        "_p",
        F.expr(
            """array_sort(transform(filter(_s, (x, k) -> coalesce(get(_s, k + 1).h = x.h, false)
               OR (k > 0 AND coalesce(get(_s, k - 1).h = x.h, false))), x -> x.i))"""
        ),
    )
    count_of = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.translate("_t", BLANKS, "")).cast("bigint").alias("word_chars"),
        count_of(SYMBOLS).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(repeated_words("_w", "_h", "_p"), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
        F.length(F.regexp_replace("_t", r"[^\p{Ll}]+", "")).cast("bigint").alias("n_lower"),
        count_of("!").cast("bigint").alias("n_exclaims"),
    )


def rule_ledger(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, measurements, and ``fail_bits``: a bit for every rule that failed."""
    rows = measure(df, text, keep)
    bits = [
        F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
        for k, condition in enumerate(RULES.values())
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return rows.withColumn("fail_bits", total)


def apply_policy(ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """The ledger with ``kept``: none of the policy's rules failed."""
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[version])))
    return ledger.withColumn("kept", failed == 0)


def ablation(ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """``(policy, rule, n_failed, n_only, n_kept, n_kept_without)``, one row per rule.

    ``n_only`` documents fail this rule alone, so they come back when it goes. One pass over
    the bits; partial sums meet in one row.
    """
    chosen = POLICIES[version]
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(chosen)))
    n_if = lambda condition: F.count(F.when(condition, 1))
    sums = ledger.agg(
        n_if(failed == 0).alias("kept"),
        *[n_if(failed.bitwiseAND(F.lit(mask([r]))) != 0).alias(f"failed_{r}") for r in chosen],
        *[n_if(failed == mask([r])).alias(f"only_{r}") for r in chosen],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(version).alias("policy"),
                F.lit(r).alias("rule"),
                F.col(f"failed_{r}").alias("n_failed"),
                F.col(f"only_{r}").alias("n_only"),
                F.col("kept").alias("n_kept"),
                (F.col("kept") + F.col(f"only_{r}")).alias("n_kept_without"),
            )
            for r in chosen
        ]
    )
    return sums.select(F.inline(rows))


def op10_quality_rules(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[1]))) != 0
    return apply_policy(rule_ledger(docs)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        "kept",
        "fail_bits",
    )


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS g FROM w, unnest(generate_series(1, len(w) - 4)) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat FROM
  (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
  length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^\p{Ll}]', '', 'g')) AS n_lower,
  length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, CAST(""" + " + ".join(
    f"CASE WHEN {condition} THEN {1 << k} ELSE 0 END" for k, condition in enumerate(RULES.values())
) + f""" AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
(fail_bits & {mask(POLICIES[1])}) <> 0 AS base_failed, (fail_bits & {mask(POLICIES[POLICY])}) = 0 AS kept, fail_bits FROM b"""
