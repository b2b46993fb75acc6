"""Token counts without moving pre-tokens.

A text is cut before every single space that a visible character follows. The byte-level pre-tokenizer always starts
a pre-token there, so each piece is a whole number of pre-tokens and its token count depends on nothing else.

Two tiers give the count of a piece. The first is a broadcast hash table of the most frequent pieces of the whole
corpus and their counts, `table_size` entries of at most `PIECE_CHARS` characters. It comes from bounded summaries:
each task keeps its own frequent pieces, and only those summaries are merged. The second is a cache in the Python
worker, filled by the tokenizer itself and emptied when full. Texts and their pre-tokens are not shuffled; the summaries
are, at most `TASK_SUMMARY` / 2 strings a task.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import short_batches

TABLE_SIZE = 65_536
#: Pieces that a task's summary holds; below half as many go on to be merged.
TASK_SUMMARY = 80_000
PIECE_CHARS = 48
CACHE_ENTRIES = 300_000

_SPLIT = re.compile(r"(?= \S)")
#: Characters on which Python and the tokenizer disagree about white space.
_DISPUTED = re.compile(r"[\x1c-\x1f]")

_loaded: dict[str, tuple] = {}
_caches: dict[str, dict[str, int]] = {}


def load_tokenizer(path: str):
    """The tokenizer of a file and the added tokens it recognises inside texts; loaded once per worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        with open(path, encoding="utf-8") as held:
            added = [t["content"] for t in json.load(held).get("added_tokens", [])]
        _loaded[path] = tokenizer, added
    return _loaded[path]


def pieces_of(text: str) -> list[str] | None:
    """The pieces of a text; None where only the tokenizer may split it."""
    if _DISPUTED.search(text):
        return None
    head, *rest = text.split(" ")
    if "  " not in text and not any(p[:1].isspace() for p in rest) and (not rest or rest[-1]):
        pieces = [" " + p for p in rest]
        if head:
            pieces.append(head)
        return pieces
    return [p for p in _SPLIT.split(text) if p]


def encode_lengths(tokenizer, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


def frequent_pieces(docs: DataFrame, text: str, size: int = TABLE_SIZE) -> list[str]:
    """The most frequent pieces of all texts, by merged task summaries; at most `size`, and so for the driver."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in short_batches(batches, 0):
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update(value.split(" "))
                    if len(seen) > 4 * TASK_SUMMARY:
                        seen = Counter(dict(seen.most_common(TASK_SUMMARY)))
        kept = [(p, n) for p, n in seen.most_common(TASK_SUMMARY // 2) if n > 1 and 0 < len(p) <= PIECE_CHARS]
        for at in range(0, len(kept), 10_000):
            part = kept[at : at + 10_000]
            yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in part], "n": [n for _, n in part]})

    top = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(summarise, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(size)
    )
    return [" " + row.piece for row in top.collect() if not row.piece[:1].isspace() and not _DISPUTED.search(row.piece)]


def count_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024, table_size: int = TABLE_SIZE
) -> DataFrame:
    """Per row of `docs`: the key, `n_bytes` of the text in UTF-8, `n_tokens` and whether they exceed `limit`.

    Token counts are those of the tokenizer file at `path` without begin, end or padding tokens; its special strings
    inside a text count as it counts them by default. A null or empty text has 0 bytes and 0 tokens. Keys may be null
    or repeated: each row gives one row. Other columns are not read. An empty table gives an empty result.
    """
    tokenizer, added = load_tokenizer(path)
    names = frequent_pieces(docs, text, table_size) if table_size else []
    names = [p for p in names if not any(a in p for a in added)]
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(names, encode_lengths(tokenizer, names), strict=True)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, added = load_tokenizer(path)
        known = shared.value.get
        cache = _caches.setdefault(path, {})
        for batch in short_batches(batches, 1):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            totals, sizes, open_pieces = [], [], []
            missing: set[str] = set()
            for value in batch.column(1).to_pylist():
                if not value:
                    totals.append(0)
                    sizes.append(0)
                    open_pieces.append(())
                    continue
                sizes.append(len(value.encode("utf-8")))
                pieces = None if any(a in value for a in added) else pieces_of(value)
                if pieces is None:
                    totals.append(len(tokenizer.encode(value, add_special_tokens=False).ids))
                    open_pieces.append(())
                    continue
                found = list(map(known, pieces))
                unknown = [p for p, n in zip(pieces, found, strict=True) if n is None] if None in found else ()
                totals.append(sum(filter(None, found)))
                open_pieces.append(unknown)
                missing.update(p for p in unknown if p not in cache)
            wanted = list(missing)
            own = dict(zip(wanted, encode_lengths(tokenizer, wanted), strict=True))
            cache.update((p, n) for p, n in own.items() if len(p) <= PIECE_CHARS)
            for i, unknown in enumerate(open_pieces):
                totals[i] += sum(own[p] if p in own else cache[p] for p in unknown)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array([t > limit for t in totals], pa.bool_())],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("string"))
    return narrow.mapInArrow(measure, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
