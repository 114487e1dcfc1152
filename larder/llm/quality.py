"""Quality rules as a ledger of failure bits.

Every rule is evaluated once, from measurements taken once.  The ledger keeps the measurements and one bit per failed
rule; policies are versioned masks over those bits, so a new policy or an ablation reads the ledger and no text.

A null or empty text has no words and fails the rule for too few words.  Repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import bind, documents, words_of

WINDOW = 5
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Rules by bit: a rule's place never changes, new ones are added at the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
)
#: Masks by version.  Version 1 has the base rules; version 2 adds symbols and odd word lengths; version 3, a strict one,
#: adds repeated lines, which some good short texts have.
POLICIES = {1: 0b00011, 2: 0b10111, 3: 0b11111}
_GAPS = " \t\n\x0b\f\r"


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five found twice or more."""

    def covered(windows: Column) -> Column:
        places = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(p: Column) -> Column:
            same = lambda e, k: F.coalesce(F.get(p, k)["h"] == e["h"], F.lit(False))
            return F.transform(F.filter(p, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"])

        def reach(starts: Column) -> Column:
            until_next = lambda s, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - s)
            return F.aggregate(F.transform(starts, until_next), F.lit(0), lambda total, n: total + n)

        return bind(F.sort_array(bind(places, repeated)), reach)

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(windows))

    def of_hashes(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(F.size(h) < WINDOW, F.lit(0)).otherwise(bind(windows, counted))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measure(text: Column) -> Column:
    """A struct of all measurements of a text."""
    text = F.coalesce(text, F.lit(""))
    solid = F.translate(text, _GAPS, "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, _GAPS, "") != "")

    def fields(words: Column, own_lines: Column) -> Column:
        values = {
            "n_words": F.size(words),
            "word_chars": F.length(solid),
            "n_symbols": F.length(text) - F.length(F.translate(text, "#*$%&|<>", "")),
            "n_lines": F.size(own_lines),
            "n_dup_lines": F.size(own_lines) - F.size(F.array_distinct(own_lines)),
            "n_repeat_words": _repeat_words(words),
        }
        return F.struct(*[values[m].cast("long").alias(m) for m in MEASUREMENTS])

    return bind(words_of(text), lambda words: bind(lines, lambda own_lines: fields(words, own_lines)))


def ledger(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, all measurements and ``failed``, with a bit for each failed rule.

    A kept column that is named like a measurement, or ``failed``, gives way to it; keep it inside a struct if it is needed.
    """
    measured = df.select(F.struct(F.lit(0).alias("__none"), *keep).alias("__k"), measure(F.col(text)).alias("__m"))
    own = {*measured.select("__m.*").columns, "failed"}
    measured = measured.select(*[F.col("__k")[c].alias(c) for c in keep if c not in own], "__m.*")
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def passes(version: int, failed: str = "failed") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(failed).bitwiseAND(F.lit(POLICIES[version])) == 0


def ablation(rows: DataFrame, version: int) -> DataFrame:
    """(rule, n_failed, n_only): rows that fail a rule, and that would pass the policy without it."""
    seen = F.col("failed").bitwiseAND(F.lit(POLICIES[version]))
    used = [(bit, name) for bit, (name, _) in enumerate(RULES) if POLICIES[version] >> bit & 1]
    sums = [F.count_if(seen.bitwiseAND(F.lit(1 << b)) != 0).alias(f"f{b}") for b, _ in used]
    sums += [F.count_if(seen == 1 << b).alias(f"o{b}") for b, _ in used]
    rules = [F.struct(F.lit(n).alias("rule"), F.col(f"f{b}").alias("n_failed"), F.col(f"o{b}").alias("n_only")) for b, n in used]
    return rows.agg(*sums).select(F.inline(F.array(*rules)))


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(documents(spark, sf_dir))
    base_failed = F.col("failed").bitwiseAND(F.lit(POLICIES[1])) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), passes(2).alias("kept"), "failed",
    )


SQL = {
    "op6_quality": r"""
with w as (
  select doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents),
places as (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w),
again as (select doc_id, i from places qualify count(*) over (partition by doc_id, ws[i:i + 4]) > 1),
covered as (select doc_id, count(distinct i + k) as n from again, range(0, 5) as r(k) group by doc_id),
m as (
  select doc_id, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(ls) as n_lines,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from w left join covered using (doc_id)),
f as (
  select *, n_words < 10 as a, 100 * n_repeat_words > 20 * n_words as b, 10 * n_symbols > n_words as c,
         100 * n_dup_lines > 30 * n_lines as d, word_chars < 2 * n_words or word_chars > 25 * n_words as e
  from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, a or b as base_failed,
       not (a or b or c or e) as kept, (a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int)::bigint as failed
from f"""
}
QUERIES = {"op6_quality": _query}
