"""Spelling variants: words one edit apart, found through a bit-sliced index of positions.

Words that differ by one inserted, deleted or replaced code point agree outside one piece of the shorter word, so
words meet in groups that share everything but one half of the word. A group with many words is cut again by the
halves of that piece, down to single code points, where the alphabet bounds its size. Inside a group one bitset
per (position, letter) of the open piece says which words have that letter there; a word is looked up by and-ing
them letter by letter, with the positions as they are and shifted by one either way, for all words of the group at
once. The set without an error and the three sets with one error move on together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import documents, written

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form occurs so many times as often as its variants.
FORM_RATIO = 10
#: A group with more words is cut again. Beyond what two free code points give, so that cutting always ends.
GROUP_WORDS = 4_096
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000

# What a word is, which letters change case, and whose hash takes a letter away.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPO_DIVISOR = 31

_RUN = re.compile(RUN)
_TO_LOWER = str.maketrans(UPPER, LOWER)


# --- words ------------------------------------------------------------------------------------


def misspelt(doc_id: int | None, run: str) -> str:
    """The run, without one code point where its hash with the document's id says so. No id, no change."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % TYPO_DIVISOR:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )
        total.clear()
        return found

    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column(1)[row].as_py()
            if not text:
                continue
            doc_id = batch.column(0)[row].as_py()
            for run, n in Counter(_RUN.findall(text)).items():
                word = misspelt(doc_id, run.lower() if run.isascii() else run.translate(_TO_LOWER))
                if len(word) >= MIN_LENGTH:
                    total[word] += n
            if len(total) >= COUNTED_WORDS:
                yield out()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least seven code points that occur twice or more in all texts.

    Tasks count their words before the shuffle. A null or empty text has none; rows that repeat count again.
    """
    counts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _counted, "word string, n long"
    )
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --- groups -----------------------------------------------------------------------------------


def _key(short: Column, low: Column, high: Column) -> Column:
    """What words of a group share: the shorter length, the open piece, and all letters outside it.

    A word of ``short`` letters is open in ``low`` to ``high``, a longer one in a place more.
    """
    longer = F.length("word") - short
    before = F.substring(F.col("word"), F.lit(1), low)
    behind = F.substring(F.col("word"), high + longer + 1, F.length("word"))
    return F.concat_ws("\n", short.cast("string"), low.cast("string"), high.cast("string"), before, behind)


def _cut(members: DataFrame) -> DataFrame:
    """Members ``word, n, short, low, high`` once for either half of the open piece."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    return (
        members.select("word", "n", "short", F.explode(halves).alias("half"))
        .select("word", "n", "short", "half.low", "half.high")
        .where("low < high")
        .withColumn("key", _key(F.col("short"), F.col("low"), F.col("high")))
    )


def _shared(members: DataFrame) -> DataFrame:
    """``key, words`` of the groups with two words or more, one of which has the shorter length."""
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("words"), F.min(F.length("word") - F.col("short")).alias("more")
    )
    return sizes.where("words > 1 and more = 0").drop("more")


def edit_groups(words: DataFrame, most: int = GROUP_WORDS) -> list[DataFrame]:
    """Members ``key, word, n, short, low, high`` of groups that hold both words of every near pair once or more.

    None has more than ``most`` words, unless its open piece is one letter. Every round cuts only the groups
    that are too large; a piece of m letters is cut log2(m) times at most.
    """
    # Either as the shorter word of a pair or one of equal length, or as the longer one.
    short = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("short")
    whole = words.select("word", "n", short).withColumns({"low": F.lit(0), "high": F.col("short")})
    members, done = _cut(whole), []
    while True:
        members = written(members, "spelling-members")
        sizes = written(_shared(members), "spelling-groups")
        large = (F.col("words") > most) & (F.col("high") - F.col("low") > 1)
        sized = members.join(sizes, "key")
        done.append(sized.where(~large).drop("words"))
        if sizes.where(F.col("words") > most).isEmpty():
            return done
        members = _cut(sized.where(large))


class PositionIndex:
    """Bitsets over the words of a group: bit i of ``at[position, letter]`` is set if word i has it there."""

    def __init__(self, pieces: list[str], short: int):
        self.at: dict[tuple[int, str], int] = {}
        self.lengths = {short: 0, short + 1: 0}
        for i, piece in enumerate(pieces):
            bit = 1 << i
            self.lengths[len(piece)] |= bit
            for place, letter in enumerate(piece):
                self.at[place, letter] = self.at.get((place, letter), 0) | bit
        self.all = (1 << len(pieces)) - 1
        self.short = short

    def near(self, piece: str) -> tuple[int, int]:
        """The words one edit from ``piece``, and those that agree with its first ``short`` letters."""
        at, none = self.at, 0
        exact, replaced, longer, shorter = self.all, none, none, none
        agree = self.all
        for i, letter in enumerate(piece):
            here, next_, last = at.get((i, letter), 0), at.get((i + 1, letter), 0), at.get((i - 1, letter), 0)
            # The word has one more letter before this one; this one is another; this one is left out.
            longer = (longer | exact) & next_
            shorter = shorter & last | exact
            replaced = replaced & here | exact
            exact &= here
            replaced &= ~exact
            if i == self.short - 1:
                agree = exact
        n, sizes = len(piece), self.lengths
        longer |= exact
        return (
            replaced & sizes.get(n, 0) & ~exact | longer & sizes.get(n + 1, 0) | shorter & sizes.get(n - 1, 0),
            agree,
        )


_NEAR = "word string, n long, n_near long, form_n long, form string"


def _near_words(group: pa.Table) -> pa.Table:
    """Per word of a group with near ones: how many they are, and the most frequent of them."""
    rows = group.sort_by([("n", "descending"), ("word", "ascending")])
    words, counts = rows["word"].to_pylist(), rows["n"].to_pylist()
    short, low, high = (rows[c][0].as_py() for c in ("short", "low", "high"))
    pieces = [w[low : high + len(w) - short] for w in words]
    size = high - low
    index = PositionIndex(pieces, size)
    out: dict[str, list] = {"word": [], "n": [], "n_near": [], "form_n": [], "form": []}
    for word, n, piece in zip(words, counts, pieces, strict=True):
        found, agree = index.near(piece)
        if high < short:  # the pair is counted where its first difference lies, and that is further on
            found &= ~agree
        if len(piece) > size:  # words of the longer length meet each other in their own groups
            found &= ~index.lengths[size + 1]
        if found:
            best = (found & -found).bit_length() - 1  # bits go by count, then by word
            for column, value in zip(out.values(), (word, n, found.bit_count(), counts[best], words[best]), strict=True):
                column.append(value)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})


def near_words(words: DataFrame, most: int = GROUP_WORDS) -> DataFrame:
    """``word, n, n_near, best, best_n`` of ``word, n``: the near words' number and the most frequent of them."""
    found = None
    for members in edit_groups(words, most):
        part = members.groupBy("key").applyInArrow(_near_words, _NEAR)
        found = part if found is None else found.unionByName(part)
    # The largest count, then the smallest word: equal counts are compared by the word alone.
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.form").alias("best"),
        (-F.col("best.minus")).alias("best_n"),
    )


def _with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``, the end of each word's chain of forms.

    Counts grow tenfold along a chain, so it is short; each round halves what is left of it.
    """
    up = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        up = written(
            up.join(further, "root", "left").select(
                "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
            ),
            "roots",
        )
        if up.where("moved").isEmpty():
            break
        up = up.drop("moved")
    return forms.join(up.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, most: int = GROUP_WORDS, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n``.

    ``form`` is the most frequent near word (ties: the smallest) if it occurs ``ratio`` times as often. Words
    must be distinct and not null. An empty vocabulary gives no row.
    """
    words = written(words.select("word", "n"), "vocabulary")
    near = near_words(words, most)
    better = F.col("best_n") >= ratio * F.col("n")
    forms = written(
        near.select(
            "word",
            F.when(better, F.col("best")).alias("form"),
            "n",
            "n_near",
            F.when(better, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    return _with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of all documents. Columns beyond ``doc_id`` and ``text`` are not read."""
    return variants(vocabulary(documents(spark, sf_dir)))


#: Pairs by what is left without one letter: of both words at the same place, or of the longer one.
OP13_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY doc_id, run
), hashed AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(regexp_replace(hex(encode(doc_id || ':' || run)), '(..)', '\\1,', 'g')[:-2], ','),
      lambda d: CAST('0x' || d AS BIGINT))),
    lambda c, d: xor(c >> 8, CAST(t[(xor(c, d) & 255) + 1] AS BIGINT)))) AS h
  FROM runs, steps
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {TYPO_DIVISOR} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), less AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
  UNION
  SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest
), near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM pairs GROUP BY word
), best AS (
  SELECT p.word, any_value(near.n_near) AS n_near, any_value(near.most) AS most, min(p.other) AS other
  FROM pairs p JOIN near ON near.word = p.word AND near.most = p.other_n GROUP BY p.word
), forms AS (
  SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near,
    CASE WHEN b.most >= {FORM_RATIO} * w.n THEN b.other END AS form, CASE WHEN b.most >= {FORM_RATIO} * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chains(word, root, up) AS (
  SELECT word, word, form FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.up
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chains c ON c.word = f.word AND c.up IS NULL
"""
