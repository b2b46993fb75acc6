"""Encoding and decoding with a word-level BPE vocabulary by speculation and verification.

Words are cut from a text by the rules of the tokenizer file. For each distinct word, greedy longest match proposes
tokens. A proposal is the right encoding exactly if every token encodes to itself and no merge would ever have crossed
a border between two neighbours. Borders of all words of a batch are checked together: `Borders.hold` undoes the
merges of the two tokens beside a border from the latest to the earliest, and at each step asks whether the two
pieces that touch would have merged before either of them grew. Words with a failing border are merged exactly.

Text-level work is map-side: no shuffle, and worker caches of bounded size hold what frequent words give.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import short_batches
from tidemark.llm.token_counts import load_tokenizer

#: Entries of a generation of the worker's caches, of chunks and of words; two generations are held.
CHUNK_ENTRIES = 150_000
WORD_ENTRIES = 200_000
CACHED_CHARS = 48
#: Symbols of a word up to which looking at all pairs is the quicker way.
SHORT = 40

#: White space as the tokenizer's pattern engine has it.
_SPACE = regex.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_NEVER = np.int64(1 << 60)


class Borders:
    """How each token came about, as arrays: its rank (-1 for a single symbol) and its two parts."""

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray, pair_rank: np.ndarray):
        self.rank, self.left, self.right = rank, left, right
        order = np.argsort(pairs)
        self._pairs, self._pair_rank = pairs[order], pair_rank[order]

    def merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of two neighbours, or never."""
        wanted = x.astype(np.int64) << 32 | y.astype(np.int64)
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._pair_rank[at], _NEVER)

    def hold(self, first: np.ndarray, second: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens that stand side by side stay apart; with `below`, until that rank only."""
        result = np.ones(len(first), dtype=bool)
        live = np.arange(len(first))
        x, y = first.astype(np.int64), second.astype(np.int64)
        x_grows = np.full(len(first), _NEVER) if below is None else below.astype(np.int64)
        y_grows = x_grows.copy()
        while len(live):
            rank = self.merge_rank(x, y)
            # of two equal merges the left one comes first
            crossed = (rank < x_grows) & ((rank < y_grows) | ((rank == y_grows) & (rank != _NEVER)))
            if below is not None:
                crossed &= rank < below[live]
            result[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            undo_y = ry >= rx
            x_grows = np.where(undo_y, x_grows, rx)[go]
            y_grows = np.where(undo_y, ry, y_grows)[go]
            x, y = np.where(undo_y, x, self.right[x])[go], np.where(undo_y, self.left[y], y)[go]
            live = live[go]
        return result


class Memo:
    """A bounded cache of two generations: what is used again moves to the young one, the old one is dropped."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def age(self) -> None:
        if len(self.young) >= self.entries:
            self.young, self.old = {}, self.young

    def recall(self, key: str):
        """An entry of the old generation, if any, moved to the young one."""
        found = self.old.get(key)
        if found is not None:
            self.young[key] = found
        return found


@dataclass
class Vocabulary:
    """What encoding needs from a tokenizer file."""

    tokenizer: object
    added: list[str]
    words: object
    symbols: dict[str, str]
    suffix: str
    ids: dict[str, int]
    names: list[str]
    longest: dict[str, int]
    ranks: dict[tuple[str, str], int]
    sound: np.ndarray
    borders: Borders


_loaded: dict[str, Vocabulary] = {}
_caches: dict[str, tuple[Memo, Memo]] = {}


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes: themselves where visible, else the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> Vocabulary:
    if path in _loaded:
        return _loaded[path]
    tokenizer, added = load_tokenizer(path)
    with open(path, encoding="utf-8") as held:
        spec = json.load(held)
    model = spec["model"]
    if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token") or model.get("dropout"):
        raise ValueError("Only plain BPE models without unknown token and dropout are encoded here")
    if model.get("ignore_merges") or model.get("continuing_subword_prefix"):
        raise ValueError("ignore_merges and continuing_subword_prefix are not supported")
    stages = spec["pre_tokenizer"]["pretokenizers"]
    split = stages[0]
    if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] or spec["decoder"] is not None:
        raise ValueError("The file must keep the matches of one pattern and have no decoder")
    suffix = model.get("end_of_word_suffix") or ""
    ids: dict[str, int] = model["vocab"]
    size = max(ids.values()) + 1
    names = [""] * size
    for name, i in ids.items():
        names[i] = name
    rank, left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    made_twice: list[int] = []
    ranks: dict[tuple[str, str], int] = {}
    pairs = np.zeros(len(model["merges"]), np.int64)
    for n, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        ranks[a, b] = n
        pairs[n] = ids[a] << 32 | ids[b]
        made = ids[a + b]
        if rank[made] >= 0:
            made_twice.append(made)
        rank[made], left[made], right[made] = n, ids[a], ids[b]
    # the length of the longest token that begins with two given symbols
    longest: dict[str, int] = {}
    for name in ids:
        if len(name) > longest.get(name[:2], 0):
            longest[name[:2]] = len(name)
    borders = Borders(rank, left, right, pairs, np.arange(len(pairs)))
    sound = np.ones(size, dtype=bool)
    merged = np.flatnonzero(rank >= 0)
    merged = merged[np.argsort(rank[merged])]
    apart = borders.hold(left[merged], right[merged], rank[merged])
    later = np.maximum(rank[left[merged]], rank[right[merged]]) < rank[merged]
    sound[merged] = apart & later
    sound[made_twice] = False
    for i in merged:  # parts have lower ranks, so they are settled
        sound[i] &= sound[left[i]] and sound[right[i]]
    _loaded[path] = Vocabulary(
        tokenizer,
        added,
        regex.compile(split["pattern"]["Regex"]),
        dict(enumerate(byte_symbols())),
        suffix,
        ids,
        names,
        longest,
        ranks,
        sound,
        borders,
    )
    return _loaded[path]


def greedy(word: str, vocabulary: Vocabulary) -> list[int]:
    """Longest tokens from the left; `word` is in byte symbols with the suffix, which stays whole."""
    ids, longest, out, at = vocabulary.ids, vocabulary.longest, [], 0
    n = len(word)
    stop = n - len(vocabulary.suffix)
    while at < n:
        end = at + longest.get(word[at : at + 2], 1)
        if end >= n:
            end = n
        elif end >= stop:
            end = stop - 1
        found = ids.get(word[at:end])
        while found is None:
            end = stop - 1 if end == n else end - 1
            if end <= at:
                raise ValueError(f"No token for {word[at]!r}")
            found = ids.get(word[at:end])
        out.append(found)
        at = end
    return out


def merge_exactly(word: str, vocabulary: Vocabulary) -> list[int]:
    """Apply the merge of lowest rank, leftmost first, until none applies."""
    stop = len(word) - len(vocabulary.suffix)
    parts = [*word[: stop - 1], word[stop - 1 :]]
    if len(parts) > SHORT:
        return _merge_long(parts, vocabulary)
    ranks = vocabulary.ranks
    never = len(ranks)
    waiting = [ranks.get(pair, never) for pair in zip(parts, parts[1:])]
    while waiting:
        least = min(waiting)
        if least == never:
            break
        i = waiting.index(least)
        parts[i] += parts.pop(i + 1)
        del waiting[i]
        if i:
            waiting[i - 1] = ranks.get((parts[i - 1], parts[i]), never)
        if i < len(waiting):
            waiting[i] = ranks.get((parts[i], parts[i + 1]), never)
    return [vocabulary.ids[p] for p in parts]


def _merge_long(parts: list[str | None], vocabulary: Vocabulary) -> list[int]:
    """The same with a heap of candidates and linked neighbours, so that n symbols take n log n steps."""
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    ranks = vocabulary.ranks
    waiting = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, a, b = heapq.heappop(waiting)
        j = after[i]
        if j < 0 or parts[i] != a or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0 and (r := ranks.get((parts[k], parts[after[k]]))) is not None:
                heapq.heappush(waiting, (r, k, parts[k], parts[after[k]]))
    return [vocabulary.ids[p] for p in parts if p is not None]


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[list[list[int]], int]:
    """Token ids of words as the pattern cuts them, and how many of them needed exact merging."""
    if not words:
        return [], 0
    table = vocabulary.symbols
    spelt = ["".join(map(table.__getitem__, w.encode("utf-8"))) + vocabulary.suffix for w in words]
    proposed = [greedy(w, vocabulary) for w in spelt]
    flat = np.fromiter((i for p in proposed for i in p), np.int64)
    sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    good = np.ones(len(words), dtype=bool)
    good[owner[~vocabulary.sound[flat]]] = False
    inner = np.ones(len(flat), dtype=bool)
    inner[ends - 1] = False
    inner &= good[owner]
    at = np.flatnonzero(inner)
    codes, back = np.unique(flat[at] << 32 | flat[at + 1], return_inverse=True)
    apart = vocabulary.borders.hold(codes >> 32, codes & 0xFFFFFFFF)
    good[owner[at[~apart[back]]]] = False
    failing = np.flatnonzero(~good)
    for i in failing:
        proposed[i] = merge_exactly(spelt[i], vocabulary)
    return proposed, len(failing)


def encode_chunks(chunks: list[str], vocabulary: Vocabulary, memo: Memo | None = None) -> list[tuple[str, str]]:
    """For texts without white space: decimal ids, and the token names, both joined by one space."""
    memo = memo or Memo(WORD_ENTRIES)
    normalise, find = vocabulary.tokenizer.normalizer.normalize_str, vocabulary.words.findall
    cut = []
    for c in chunks:
        # in ASCII, normalising is lower case, and letters alone are one word
        c = c.lower() if c.isascii() else normalise(c)
        cut.append([c] if c.isascii() and c.isalpha() else find(c))
    held = memo.young
    missing = {w for words in cut for w in words if w not in held and memo.recall(w) is None}
    distinct = list(missing)
    encoded, _ = encode_words(distinct, vocabulary)
    names = vocabulary.names
    own = {w: (" ".join(map(str, ids)), " ".join([names[i] for i in ids])) for w, ids in zip(distinct, encoded, strict=True)}
    out = []
    for words in cut:
        found = [own[w] if w in own else held[w] for w in words]
        out.append(found[0] if len(found) == 1 else (" ".join([f[0] for f in found]), " ".join([f[1] for f in found])))
    held.update((w, e) for w, e in own.items() if len(w) <= CACHED_CHARS)
    memo.age()
    return out


def encode_text(text: str, vocabulary: Vocabulary, entry) -> list[tuple[str, str]]:
    """Ids and names of the chunks of a text as `entry` gives them; added tokens stand for themselves."""
    marked = [a for a in vocabulary.added if a in text]
    parts = regex.split("(" + "|".join(map(regex.escape, sorted(marked, key=len, reverse=True))) + ")", text) if marked else [text]
    found = []
    for part in parts:
        if part in marked:
            found.append((str(vocabulary.tokenizer.token_to_id(part)), part))
        else:
            found += [entry(c) for c in _SPACE.split(part) if c]
    return found


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The names of the tokens joined by one space, as a file without decoder asks; unknown ids are left out."""
    held = vocabulary.names
    names = [held[i] if 0 <= i < len(held) and held[i] else vocabulary.tokenizer.id_to_token(i) for i in ids]
    return " ".join(n for n in names if n is not None)


def encode_ids(text: str, vocabulary: Vocabulary) -> list[int]:
    """All token ids of one text."""
    found = encode_text(text, vocabulary, lambda c: encode_chunks([c], vocabulary)[0])
    return [int(i) for ids, _ in found for i in ids.split()]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", digests: bool = True) -> DataFrame:
    """Per row of `docs`: the key, `n_tokens`, and either digests or the real outputs.

    With `digests`, `ids_sha256` is the SHA-256 of the decimal ids joined by one space and `decoded_sha256` that of the
    decoded text, both in lower-case hex; without, `ids` is the list of ids and `decoded` the decoded text. A null or
    empty text, or one of white space only, has no tokens, an empty id list and an empty decoded text. Added tokens
    inside a text are recognised as the tokenizer does by default. Keys may be null or repeated: each row gives one
    row. Other columns are not read. An empty table gives an empty result. The length of a text is not limited.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        memo, words = _caches.setdefault(path, (Memo(CHUNK_ENTRIES), Memo(WORD_ENTRIES)))
        for batch in short_batches(batches, 1):
            memo.age()
            held = memo.young
            values = [v or "" for v in batch.column(1).to_pylist()]
            chunks: list[list[str] | None] = []
            missing: set[str] = set()
            for value in values:
                if any(a in value for a in vocabulary.added):
                    chunks.append(None)
                    for part in regex.split("|".join(map(regex.escape, vocabulary.added)), value):
                        missing.update(c for c in _SPACE.split(part) if c and c not in held)
                    continue
                odd = "\x1c" in value or "\x1d" in value or "\x1e" in value or "\x1f" in value
                cut = [c for c in _SPACE.split(value) if c] if odd else value.split()
                chunks.append(cut)
                missing.update([c for c in cut if c not in held])
            wanted = [c for c in missing if memo.recall(c) is None]
            own = dict(zip(wanted, encode_chunks(wanted, vocabulary, words), strict=True))
            held.update((c, e) for c, e in own.items() if len(c) <= CACHED_CHARS)
            # what is too long for the cache is looked up in `own`
            entry = lambda c: held[c] if c in held else own[c]
            sizes, first, second = [], [], []
            for value, cut in zip(values, chunks, strict=True):
                if cut is None:
                    found = encode_text(value, vocabulary, entry)
                else:
                    found = list(map(held.get, cut))
                    if None in found:
                        found = [own[c] if f is None else f for c, f in zip(cut, found, strict=True)]
                found = [f for f in found if f[0]] if ("", "") in found else found
                joined, decoded = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
                sizes.append(joined.count(" ") + 1 if joined else 0)
                if digests:
                    first.append(hashlib.sha256(joined.encode("ascii")).hexdigest())
                    second.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                else:
                    first.append([int(i) for i in joined.split(" ")] if joined else [])
                    second.append(decoded)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.string() if digests else pa.list_(pa.int32())), pa.array(second, pa.string())],
                names=[key, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))],
            )

    kind = docs.schema[key].dataType.simpleString()
    outputs = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    narrow = docs.select(F.col(key), F.col(text).cast("string"))
    return narrow.mapInArrow(work, f"`{key}` {kind}, n_tokens long, {outputs}")
