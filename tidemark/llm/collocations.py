"""Phrases whose words keep together, counted over a prefix-free parse.

Texts are cut into pieces at punctuation and line ends, and pieces into words. A piece is parsed into chunks that begin
at its start and at every window of three words whose hash says so; a chunk ends with the window that begins the next
one, so neighbouring chunks overlap by three words. Where a chunk ends depends on its words only, so passages that
occur in many texts fall into the same chunks, whatever stands around them. The distinct chunks with the number of
times they occur are the dictionary; all counting reads the dictionary alone.

A phrase of up to four words lies whole in the chunk in which it starts before the overlap, and in no other in that way.
So phrases that start there, each weighted by its chunk's frequency, are all occurrences, each counted once.

Rare phrases are not counted in full: a phrase can occur `least` times only if the two phrases that lack its last or
first word do. Words are counted first, then pairs of frequent words, then runs of three and four words all of whose
pairs are frequent. What is frequent reaches the tasks as a table of bits by hash of bounded size; chance hits cost work
only, since counts are by the phrases themselves and the limit is applied to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import byte_set, cut_out, flat_texts, lower_ascii, mix, run_hashes, short_batches, slices, span_hashes, word_spans
from tidemark.llm.bitmaps import hits_sized, sized_bitmap
from tidemark.llm.common import stored

#: Words of the longest phrase, and of the overlap of chunks.
LONGEST = 4
OVERLAP = LONGEST - 1
#: Parts of a language's phrases that are ranked on their own first.
DEALS = 64
#: A window of words begins a chunk once in so many.
PERIOD = 12

_SPLIT = byte_set(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
_BLANK = byte_set((0x20, 0x20), (0x09, 0x09))
_WORD = ~(_SPLIT | _BLANK)
_IN_CHUNK = ~byte_set((0x20, 0x20))


def _squeezed(data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with one space in place of each run of spaces and tabs."""
    blank = _BLANK[data]
    stay = ~blank
    stay[1:] |= ~blank[:-1]
    stay[marks[:-1][np.diff(marks) > 0]] = True
    before = np.concatenate(([0], np.cumsum(stay)))
    return np.where(blank, np.uint8(0x20), data)[stay], before[marks]


def parse(data: np.ndarray, marks: np.ndarray, period: int = PERIOD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of texts in lower case and with single spaces: their bytes' starts and ends, the number of words before
    the overlap, and the text each is from."""
    starts, ends, _ = word_spans(data, marks, _WORD)
    if not len(starts):
        return starts, ends, starts, starts
    # a word begins a piece if punctuation or the border of a text lies before it
    splits = np.concatenate(([0], np.cumsum(_SPLIT[data])))
    text = np.searchsorted(marks, starts, side="right") - 1
    begins = np.ones(len(starts) + 1, dtype=bool)
    begins[1:-1] = (splits[starts[1:]] != splits[ends[:-1]]) | (text[1:] != text[:-1])
    piece_ends = np.flatnonzero(begins)[1:]
    piece_end = np.repeat(piece_ends, np.diff(np.flatnonzero(begins)))
    windows = run_hashes(span_hashes(data, starts, ends), OVERLAP)
    opens = begins[:-1].copy()
    opens[: len(windows)] |= (windows % np.uint64(period) == 0) & (np.arange(len(windows)) + OVERLAP <= piece_end[: len(windows)])
    first = np.flatnonzero(opens)
    upto = np.append(first[1:], len(starts))
    last = np.where(begins[upto], upto, upto + OVERLAP) - 1
    return starts[first], ends[last], upto - first, text[first]


def chunk_counts(docs: DataFrame, text: str = "text", lang: str = "lang", period: int = PERIOD) -> DataFrame:
    """The dictionary: `lang`, `chunk` (words joined by one space), `own` (words before the overlap) and `n`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 1):
            data, marks = flat_texts(batch.column(1))
            for a, b in slices(marks):
                part, own = _squeezed(lower_ascii(data[marks[a] : marks[b]]), marks[a : b + 1] - marks[a])
                starts, ends, words, at = parse(part, own, period)
                chunks = {"lang": batch.column(0).slice(a, b - a).take(pa.array(at)), "chunk": cut_out(part, starts, ends).cast(pa.string()), "own": pa.array(words, pa.int32())}
                counted = pa.table(chunks).group_by(["lang", "chunk", "own"]).aggregate([([], "count_all")])
                yield from counted.rename_columns({"count_all": "n"}).select(["lang", "chunk", "own", "n"]).to_batches()

    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text).cast("string"))
    found = narrow.mapInArrow(work, "lang string, chunk string, own int, n long")
    return found.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


def _language_salts(langs: pa.Array) -> np.ndarray:
    """A number for each row's language, the same in every task."""
    coded = langs.dictionary_encode()
    salts = [int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "big") for v in coded.dictionary.to_pylist()]
    return np.array(salts, dtype=np.uint64)[coded.indices.to_numpy()]


def _counted(chunks: DataFrame, sizes: tuple[int, ...], parts: int = 0, bits=None) -> DataFrame:
    """`lang`, `phrase` and `a` of the phrases of `sizes` words; only those all of whose runs of `parts` words hit `bits`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 1):
            data, marks = flat_texts(batch.column(1))
            salts, own, weight = _language_salts(batch.column(0)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for a, b in slices(marks):
                part, edges = data[marks[a] : marks[b]], marks[a : b + 1] - marks[a]
                yield from _phrases(part, edges, salts[a:b], own[a:b], weight[a:b], batch.column(0).slice(a, b - a), sizes, parts, bits.value if bits else None)

    found = chunks.select("lang", "chunk", "own", "n").mapInArrow(work, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("a"))


def _phrases(data, marks, salts, own, weight, langs, sizes, parts, bits) -> Iterator[pa.RecordBatch]:
    """The distinct phrases of some chunks with their weights."""
    starts, ends, upto = word_spans(data, marks, _IN_CHUNK)
    if not len(starts):
        return
    chunk = np.repeat(np.arange(len(salts)), np.diff(upto))
    place = np.arange(len(starts)) - upto[:-1][chunk]
    counted, left = place < own[chunk], upto[1:][chunk] - np.arange(len(starts))
    frequent = None
    if parts:
        whole = np.flatnonzero(left >= parts)
        keys = mix(span_hashes(data, starts[whole], ends[whole + parts - 1]) ^ salts[chunk[whole]])
        frequent = np.zeros(len(starts) + LONGEST, dtype=bool)
        frequent[whole] = hits_sized(bits, keys)
    for size in sizes:
        chosen = counted & (left >= size)
        for k in range(size - parts + 1 if parts else 0):
            chosen &= frequent[k : k + len(starts)]
        at = np.flatnonzero(chosen)
        if not len(at):
            continue
        first, last = starts[at], ends[at + size - 1]
        one = span_hashes(data, first, last) ^ mix(salts[chunk[at]])
        two = span_hashes(data, first, last, 1)
        order = np.argsort(one, kind="stable")
        fresh = np.ones(len(at), dtype=bool)
        # rows of one group agree in 128 bits; a phrase may form several groups, which are added up later
        fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        heads = np.flatnonzero(fresh)
        n = np.add.reduceat(weight[chunk[at[order]]], heads)
        kept = order[heads]
        yield pa.RecordBatch.from_arrays(
            [langs.take(pa.array(chunk[at[kept]])), cut_out(data, first[kept], last[kept]).cast(pa.string()), pa.array(n, pa.int64())],
            names=["lang", "phrase", "n"],
        )


def _keys(phrases: DataFrame) -> DataFrame:
    """`key` of each phrase, as `_phrases` looks it up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 1):
            data, marks = flat_texts(batch.column(1))
            keys = mix(span_hashes(data, marks[:-1], marks[1:]) ^ _language_salts(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return phrases.select("lang", "phrase").mapInArrow(work, "key long")


def phrase_counts(chunks: DataFrame, least: int) -> DataFrame:
    """All phrases of 1 to 4 words that occur `least` times or more: `lang`, `phrase`, `words`, `a`."""
    context = chunks.sparkSession.sparkContext
    found, parts, bits = [], 0, None
    for sizes in ((1,), (2,), (3, 4)):
        level = stored(_counted(chunks, sizes, parts, bits).filter(F.col("a") >= least), "phrases")
        found.append(level)
        if sizes != (3, 4):
            parts, bits = sizes[0], context.broadcast(sized_bitmap(_keys(level), "key", level.count()))
    whole = found[0].unionByName(found[1]).unionByName(found[2])
    return whole.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "a")


def _lowest_cuts(phrases: DataFrame) -> DataFrame:
    """For phrases of two words and more: counts of both parts and score of the cut of least score."""
    sides = phrases.filter("words > 1").select("lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    first = F.expr("substring_index(phrase, ' ', k)")
    sides = sides.select("*", first.alias("first"), F.expr("substring(phrase, char_length(substring_index(phrase, ' ', k)) + 2)").alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cut = sides.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    return cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def _inside_longer(phrases: DataFrame) -> DataFrame:
    """`lang`, `phrase` and the count `longer` of the most frequent phrase of more words that holds it."""
    lists = phrases.filter("words > 2").select("lang", "words", "a", F.split("phrase", " ").alias("list"))
    sized = lists.select("*", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    placed = sized.select("*", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    held = placed.select("lang", F.expr("array_join(slice(list, at, size), ' ')").alias("phrase"), "a")
    return held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000, held_percent: int = 80, period: int = PERIOD) -> DataFrame:
    """The `top` phrases of each language by how much their words keep together.

    Columns: `lang` (a null one is `und`), `rank` from 1, `phrase`, its occurrences `a`, those of its two parts `l` and
    `r`, the words `n` of the language, and `score`, the floor of 2000000 a / (l + r) at the cut where it is least (the
    first of equal ones). Phrases have 2 to 4 words, occur `least` times or more, and lie in no longer such phrase that
    has at least `held_percent` percent of their occurrences. Order: score, then `a`, both falling, then phrase by its
    bytes. A-Z counts as a-z. Null and empty texts have no words; repeated rows count as often as they stand. An empty
    table gives an empty result. Other columns are not read.
    """
    chunks = stored(chunk_counts(docs, text, lang, period), "phrase-chunks")
    phrases = stored(phrase_counts(chunks, least), "phrases")
    total = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    apart = F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * held_percent)
    kept = _lowest_cuts(phrases).join(_inside_longer(phrases), ["lang", "phrase"], "left").filter(apart)
    # the first of each language come from the first of its deals, so no task reads more than those
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    dealt = kept.withColumn("deal", F.pmod(F.hash("phrase"), F.lit(DEALS)))
    firsts = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).filter(F.col("place") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
lists AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM places, (VALUES (1), (2), (3), (4)) AS sizes(k)
  WHERE i + k - 1 <= len(w)
),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1 : c], ' ') AS first, array_to_string(w[c + 1 : k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.c, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = c.first
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates))
  GROUP BY ALL
),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN held USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
