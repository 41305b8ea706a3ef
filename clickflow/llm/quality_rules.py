"""Rules of text quality judged per document and per host, with DataFrame and SQL functions alone.

Every document is measured and held against the rules. Failures are counted per host; a host's failure
rate is shrunk towards the mean of all hosts by a beta prior fitted to the hosts' rates, so that a
host with few documents is not judged by them alone. A host whose shrunk rate is too high is rejected, and
its verdict joins back to its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import documents, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 15
#: A host is rejected if more than this share of its documents fails, after shrinking.
MAX_HOST_RATE = 0.5
_SPACE = r"[\\x20\\x09-\\x0D]+"
_WORD = r"[^\\x20\\x09-\\x0D]"


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the measures of ``text``: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Windows of three words are compared by 64-bit hashes; they are sorted only where one occurs twice, so
    the cost is n log n for any text. A null text has no words.
    """
    text = "coalesce(text, '')"
    parted = docs.selectExpr(
        *keep,
        f"filter(split({text}, '{_SPACE}'), w -> w <> '') AS _words",
        f"filter(split({text}, '\\n'), l -> l RLIKE '{_WORD}') AS _lines",
        f"cast(regexp_count({text}, '[#*$%&|<>]') AS bigint) AS n_symbols",
    )
    grams = parted.selectExpr(
        *keep,
        "n_symbols",
        "cast(size(_words) AS bigint) AS n_words",
        "cast(length(array_join(_words, '')) AS bigint) AS word_chars",
        "cast(size(_lines) AS bigint) AS n_lines",
        "cast(size(_lines) - size(array_distinct(_lines)) AS bigint) AS n_dup_lines",
        "CASE WHEN size(_words) < 3 THEN cast(array() AS array<bigint>) "
        "ELSE transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END "
        "AS _grams",
    )
    measures = ["n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    pairs = grams.selectExpr(
        *keep,
        *measures,
        "CASE WHEN size(array_distinct(_grams)) < size(_grams) "
        "THEN sort_array(transform(_grams, (h, i) -> named_struct('h', h, 'i', i))) "
        "ELSE cast(array() AS array<struct<h: bigint, i: int>>) END AS _pairs",
    )
    starts = pairs.selectExpr(
        *keep,
        *measures,
        "sort_array(transform(filter(_pairs, (p, k) -> "
        "(k > 0 AND _pairs[greatest(k - 1, 0)].h = p.h) OR "
        "(k < size(_pairs) - 1 AND _pairs[least(k + 1, size(_pairs) - 1)].h = p.h)), p -> p.i)) AS _starts",
    )
    return starts.selectExpr(
        *keep,
        *measures,
        "aggregate(_starts, named_struct('last', -3, 'n', 0L), "
        "(s, i) -> named_struct('last', i, 'n', s.n + least(3, i - s.last)), s -> s.n) AS n_repeat_words",
    )


def _rules() -> dict[str, object]:
    c = F.col
    return {
        "few_words": c("n_words") < MIN_WORDS,
        "repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"),
        "symbols": 100 * c("n_symbols") > MAX_SYMBOL_PERCENT * c("n_words"),
        "dup_lines": 100 * c("n_dup_lines") > MAX_DUP_LINE_PERCENT * c("n_lines"),
        "word_length": (c("word_chars") < MIN_WORD_CHARS * c("n_words"))
        | (c("word_chars") > MAX_WORD_CHARS * c("n_words")),
    }


BASE_RULES = ("few_words", "repeats")


def _prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and weight of the beta prior, by moments: spread of the host rates beyond what counting gives."""
    n, f = F.col("host_docs"), F.col("host_failed")
    row = hosts.agg(
        F.sum(n).alias("n"), F.sum(f).alias("f"), F.count("*").alias("hosts"), F.sum(f * f / n).alias("squares")
    ).first()
    if not row["n"]:
        return 0.0, 1.0
    mean = row["f"] / row["n"]
    noise = mean * (1 - mean)
    spread = row["squares"] / row["n"] - mean * mean - noise * row["hosts"] / row["n"]
    weight = noise / spread - 1 if spread > 0 else float("inf")
    return mean, min(max(weight, 1.0), 1e6)


def judge(
    docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, the measures, base_failed, failed_rules, host_rate, kept.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. ``kept`` is false
    for a document that fails any rule, and for all documents of a host whose shrunk failure rate is
    above ``max_host_rate``. A null host is a host of its own. Rows are judged one by one, also if they
    repeat; a null text has no words and fails. Columns other than doc_id, text and ``host`` are not read.
    Measures are written once; the texts are not shuffled.
    """
    named = docs.select("doc_id", F.col(f"`{host}`").cast("string").alias("host"), F.col("text").cast("string"))
    rules = _rules()
    failed = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))
    measured = written(
        measure(named, "doc_id", "host").withColumn("failed_rules", failed), "quality-measures"
    )
    hosts = written(
        measured.groupBy("host").agg(
            F.count("*").alias("host_docs"),
            F.sum((F.size("failed_rules") > 0).cast("long")).alias("host_failed"),
        ),
        "hosts",
    )
    mean, weight = _prior(hosts)
    rated = hosts.select(
        F.col("host").alias("rated_host"),
        F.round((F.col("host_failed") + mean * weight) / (F.col("host_docs") + weight), 6).alias("host_rate"),
    )
    base = F.lit(False)
    for name in BASE_RULES:
        base = base | F.array_contains("failed_rules", name)
    return (
        measured.join(rated, F.col("host").eqNullSafe(F.col("rated_host")))
        .withColumn("base_failed", base)
        .withColumn("kept", (F.size("failed_rules") == 0) & (F.col("host_rate") <= max_host_rate))
        .select(
            "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "failed_rules", "host_rate", "kept",
        )
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_rate", F.array_join("failed_rules", ",").alias("failed_rules"),
    )


OP1_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents
), w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from d
), g as (
  select r, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3
), h as (
  select r, i, count(*) over (partition by r, words[i], words[i + 1], words[i + 2]) as n from g
), c as (
  select r, count(distinct k) as n_repeat_words
  from (select r, unnest([i, i + 1, i + 2]) as k from h where n > 1) group by r
), m as (
  select doc_id, source, cast(len(words) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(lines) as bigint) as n_lines,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from w left join c using (r)
), t as (
  select *, n_words < 50 as a, 100 * n_repeat_words > 50 * n_words as b, 100 * n_symbols > 10 * n_words as e,
         100 * n_dup_lines > 50 * n_lines as f, word_chars < 2 * n_words or word_chars > 15 * n_words as l
  from m
), s as (
  select source, cast(count(*) as double) as n,
         cast(count(*) filter (where a or b or e or f or l) as double) as bad from t group by source
), p as (
  select sum(bad) / sum(n) as mean, sum(bad * bad / n) / sum(n) as squares, count(*) / sum(n) as share from s
), q as (
  select mean, mean * (1 - mean) as noise, squares - mean * mean - mean * (1 - mean) * share as spread from p
), v as (
  select mean, least(greatest(case when spread > 0 then noise / spread - 1 else 1e6 end, 1), 1e6) as weight from q
), k as (
  select source, round((bad + mean * weight) / (n + weight), 6) as host_rate from s, v
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a or b as base_failed,
       not (a or b or e or f or l) and host_rate <= 0.5 as kept, host_rate,
       concat_ws(',', case when a then 'few_words' end, case when b then 'repeats' end, case when e then 'symbols' end,
                 case when f then 'dup_lines' end, case when l then 'word_length' end) as failed_rules
from t join k on t.source is not distinct from k.source
"""
