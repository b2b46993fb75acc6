"""Encoding and decoding with a SentencePiece BPE model by vectorised merge rounds.

A text is normalised as the model asks (one space in front, spaces as `▁`) and cut between any two characters that stand
side by side in no piece of the model: no merge can cross such a border, so the parts are encoded on their own. The
distinct parts of a batch that the worker has not met lie one after the other in one array of symbols. Each round
finds the least pair rank of every part, joins that pair at its leftmost places in all parts at once, and closes the
gaps; parts without a pair leave the array.

A round may join several places of a part only while none of the joins makes a pair of a better or equal rank, since
the model would take that one first; later places wait for the next round. So every part goes through the very merges
that the model's own order has.

Text-level work is map-side: no shuffle, and worker caches of bounded size hold what frequent parts give.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import flat_texts, short_batches

#: Parts that a worker's cache holds, of at most so many bytes each; it is emptied when full.
CACHE_ENTRIES = 400_000
CACHED_BYTES = 64
#: Bytes of new parts that go through the rounds together, or one longer part.
ROUND_BYTES = 1 << 21

SPACE = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)


@dataclass
class Pieces:
    """A model as arrays. Symbols are token ids, or further numbers for characters that are no piece of their own."""

    bytes_of: pa.Array
    visible: np.ndarray
    normal: np.ndarray
    fallback: np.ndarray
    unknown: int
    end: int
    letters: np.ndarray
    letter_symbol: np.ndarray
    pairs: np.ndarray
    pair_rank: np.ndarray
    pair_token: np.ndarray
    beside: np.ndarray

    def symbols_of(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each character, -1 for one that occurs in no piece."""
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, self.letter_symbol[at], np.int32(-1))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and token of each pair of symbols; `_NONE` and -1 where the pair is no piece."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        known = self.pairs[at] == keys
        return np.where(known, self.pair_rank[at], _NONE), np.where(known, self.pair_token[at], np.int32(-1))


_loaded: dict[str, Pieces] = {}
_caches: dict[str, dict[bytes, bytes]] = {}


def load_pieces(path: str) -> Pieces:
    """The model of a file, once per worker.

    Raises `ValueError` for what the rounds do not cover: models other than BPE with byte fallback, character maps,
    removal of extra white space, pieces of the user.
    """
    if path not in _loaded:
        _loaded[path] = _read(path)
    return _loaded[path]


def _read(path: str) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as held:
        model.ParseFromString(held.read())
    kinds = proto.ModelProto.SentencePiece
    rules, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != proto.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback are covered")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
        raise ValueError("only models that change nothing but spaces are covered")
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("pieces of the user and unused pieces are not covered")
    names = [p.piece for p in model.pieces]
    normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
    end = next((i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL and p.piece == trained.eos_piece), -1)
    fallback = np.full(256, unknown, dtype=np.int32)
    written, visible = [], np.zeros(len(names), dtype=bool)
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            value = int(p.piece[3:5], 16)
            fallback[value] = i
            written.append(bytes([value]))
        elif p.type == kinds.NORMAL:
            written.append(p.piece.replace(SPACE, " ").encode("utf-8"))
        else:
            written.append(trained.unk_surface.encode("utf-8") if p.type == kinds.UNKNOWN else b"")
        visible[i] = p.type != kinds.CONTROL
    symbols = {c: normal[c] for p in normal for c in p if c in normal}
    for c in sorted({c for p in normal for c in p} - set(symbols)):
        symbols[c] = len(names) + len(symbols)
    # the rank of a piece is its place among all scores; equal scores share it
    order = {s: i for i, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
    every = normal | symbols
    keys, ranks, tokens, beside = [], [], [], set()
    for piece, i in normal.items():
        beside.update(zip(piece, piece[1:]))
        for k in range(1, len(piece)):
            left, right = every.get(piece[:k]), every.get(piece[k:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                ranks.append(order[model.pieces[i].score])
                tokens.append(i)
    keys = np.array(keys, dtype=np.int64)
    sorting = np.argsort(keys)
    letters = sorted(symbols)
    return Pieces(
        bytes_of=pa.array(written, pa.large_binary()),
        visible=visible,
        normal=np.array([p.type == kinds.NORMAL for p in model.pieces]),
        fallback=fallback,
        unknown=unknown,
        end=end,
        letters=np.array([ord(c) for c in letters], dtype=np.uint32),
        letter_symbol=np.array([symbols[c] for c in letters], dtype=np.int32),
        pairs=keys[sorting],
        pair_rank=np.array(ranks, dtype=np.int32)[sorting],
        pair_token=np.array(tokens, dtype=np.int32)[sorting],
        beside=np.array(sorted(ord(a) << 32 | ord(b) for a, b in beside), dtype=np.int64),
    )


def merge_rounds(symbols: np.ndarray, parts: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, int]:
    """Merge the symbols of all parts to the end: final symbols in order, how many each part has, and the rounds.

    `parts` has the first place of each part and the length of the whole; no part is empty.
    """
    counts = np.diff(parts)
    final = symbols.copy()
    sizes = counts.copy()
    owner = np.arange(len(counts))
    home = parts[:-1].copy()
    rank, token = _ranks(symbols, counts, pieces)
    rounds = 0
    while len(symbols):
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        least = np.minimum.reduceat(rank, starts)
        done = least == _NONE
        if done.any():
            _put(final, home[done], symbols, starts[done], counts[done])
            sizes[owner[done]] = counts[done]
            stay = np.repeat(~done, counts)
            symbols, rank, token = symbols[stay], rank[stay], token[stay]
            counts, owner, home, least = counts[~done], owner[~done], home[~done], least[~done]
            if not len(symbols):
                break
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        rounds += 1
        of = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(rank == least[of])
        at = at[_leftmost(at, of)]
        at = at[_in_order(at, of, least, symbols, token, starts, counts, pieces)]
        symbols[at] = token[at]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        counts = counts - np.bincount(of[at], minlength=len(counts))
        moved = (np.cumsum(stay) - 1)[at]
        symbols, rank, token = symbols[stay], rank[stay], token[stay]
        # pairs that a joined symbol begins or ends are new
        last = np.zeros(len(symbols), dtype=bool)
        last[np.cumsum(counts) - 1] = True
        touched = np.zeros(len(symbols), dtype=bool)
        touched[moved] = True
        touched[moved[moved > 0] - 1] = True
        changed = np.flatnonzero(touched)
        ends = last[changed]
        rank[changed[ends]], token[changed[ends]] = _NONE, -1
        inner = changed[~ends]
        rank[inner], token[inner] = pieces.look_up(symbols[inner], symbols[inner + 1])
    places = np.concatenate(([0], np.cumsum(sizes)))
    taken = np.repeat(parts[:-1] - places[:-1], sizes) + np.arange(places[-1])
    return final[taken], sizes, rounds


def _ranks(symbols: np.ndarray, counts: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Rank and token of each symbol with the next one of its part."""
    rank, token = np.full(len(symbols), _NONE), np.full(len(symbols), -1, dtype=np.int32)
    inner = np.ones(len(symbols), dtype=bool)
    inner[np.cumsum(counts) - 1] = False
    at = np.flatnonzero(inner)
    rank[at], token[at] = pieces.look_up(symbols[at], symbols[at + 1])
    return rank, token


def _put(final: np.ndarray, home: np.ndarray, symbols: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    final[np.repeat(home, counts) + inside] = symbols[np.repeat(starts, counts) + inside]


def _leftmost(at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Of places that overlap, every second one from the left on: a place's pair takes the next symbol with it."""
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    return (np.arange(len(at)) - first) % 2 == 0


def _in_order(at, of, least, symbols, token, starts, counts, pieces: Pieces) -> np.ndarray:
    """Which of the places the model joins one after the other: up to the first of a part that makes a better pair."""
    parts = of[at]
    if not (parts[1:] == parts[:-1]).any():
        return np.ones(len(at), dtype=bool)
    joined, limit = token[at], least[parts]
    better = np.zeros(len(at), dtype=bool)
    right = at + 2 < (starts + counts)[parts]
    found, _ = pieces.look_up(joined[right], symbols[at[right] + 2])
    better[right] = found <= limit[right]
    left = at > starts[parts]
    before = symbols[np.maximum(at - 1, 0)].copy()
    after_join = np.zeros(len(at), dtype=bool)
    after_join[1:] = (at[1:] == at[:-1] + 2) & (parts[1:] == parts[:-1])
    before[after_join] = joined[np.flatnonzero(after_join) - 1]
    found, _ = pieces.look_up(before[left], joined[left])
    better[left] |= found <= limit[left]
    # a place stays if no earlier place of its part is followed by a better pair
    sums = np.concatenate(([0], np.cumsum(better)))
    first = np.ones(len(at), dtype=bool)
    first[1:] = parts[1:] != parts[:-1]
    base = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return sums[:-1] == sums[base]


def cut_parts(codes: np.ndarray, marks: np.ndarray, pieces: Pieces) -> np.ndarray:
    """First places of the parts of texts given as characters, texts starting at `marks[:-1]`; ends with the length."""
    pairs = codes[:-1].astype(np.int64) << 32 | codes[1:].astype(np.int64)
    at = np.minimum(np.searchsorted(pieces.beside, pairs), len(pieces.beside) - 1)
    apart = np.ones(len(codes) + 1, dtype=bool)
    apart[1:-1] = pieces.beside[at] != pairs
    apart[marks] = True
    return np.flatnonzero(apart) if len(codes) else np.zeros(1, dtype=np.int64)


def encode_parts(parts: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the given texts, already normalised, one after the other, and their number for each."""
    if not parts:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    joined = b"".join(parts)
    codes = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    letters_before = np.concatenate(([0], np.cumsum((np.frombuffer(joined, dtype=np.uint8) & 0xC0) != 0x80)))
    marks = letters_before[np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))]
    bounds = cut_parts(codes, marks, pieces)
    letters = pieces.symbols_of(codes)
    symbols, counts, _ = merge_rounds(letters, bounds, pieces)
    # how many symbols each text has: parts never cross texts
    before = np.concatenate(([0], np.cumsum(counts)))
    per_text = np.diff(before[np.searchsorted(bounds, marks)])
    odd = np.flatnonzero((symbols < 0) | (symbols >= len(pieces.visible)))
    if not len(odd):
        return symbols, per_text
    return _spell_out(symbols, per_text, odd, codes[pieces.symbols_of(codes) < 0], pieces)


def _spell_out(symbols, per_text, odd, unseen, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Characters that are no piece become the tokens of their bytes; `unseen` has those of no symbol, in order."""
    letter_of = dict(zip(pieces.letter_symbol.tolist(), pieces.letters.tolist(), strict=True))
    rest = iter(unseen.tolist())
    spelt = [chr(next(rest) if s < 0 else letter_of[s]).encode("utf-8") for s in symbols[odd].tolist()]
    sizes = np.ones(len(symbols), dtype=np.int64)
    sizes[odd] = [len(b) for b in spelt]
    out = np.repeat(symbols, sizes)
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(spelt), dtype=np.uint8)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes[odd]) - sizes[odd], sizes[odd])
    out[np.repeat((ends - sizes)[odd], sizes[odd]) + inside] = pieces.fallback[flat]
    text_ends = np.cumsum(per_text)
    upto = np.concatenate(([0], ends))
    return out, np.diff(upto[np.concatenate(([0], text_ends))])


def word_spans(data: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Starts of the words of normalised texts: where spaces begin after something else, and where texts begin."""
    space = data == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[marks[:-1][np.diff(marks) > 0]] = True
    return np.flatnonzero(first)


def _normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space in front, empty ones left empty, and with literal `▁` as spaces; as bytes and offsets."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.replace_substring(column, SPACE, " ")
    full = pc.greater(pc.binary_length(column), 0)
    return flat_texts(pc.if_else(full, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string())), column))


def encode_column(column: pa.Array, pieces: Pieces, cache: dict[bytes, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts of a column, one after the other, and the n + 1 offsets of the texts in them."""
    cache = {} if cache is None else cache
    data, marks = _normalised(column)
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(len(marks), dtype=np.int64)
    starts = word_spans(data, marks)
    bounds = np.concatenate((starts, [len(data)]))
    # spaces become the model's sign only in the distinct words
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = words.dictionary_encode()
    names = coded.dictionary.to_pylist()
    found = [cache.get(w) for w in names]
    missing = [i for i, f in enumerate(found) if f is None]
    at = 0
    while at < len(missing):
        part, size = [], 0
        while at + len(part) < len(missing) and (not part or size < ROUND_BYTES):
            part.append(missing[at + len(part)])
            size += len(names[part[-1]])
        ids, counts = encode_parts([names[i].replace(b" ", SPACE.encode()) for i in part], pieces)
        raw, upto = ids.astype(np.int32).tobytes(), np.concatenate(([0], np.cumsum(counts))).tolist()
        for j, i in enumerate(part):
            found[i] = raw[4 * upto[j] : 4 * upto[j + 1]]
        at += len(part)
    if len(cache) + len(missing) > CACHE_ENTRIES:
        cache.clear()
    cache.update((names[i], found[i]) for i in missing[:CACHE_ENTRIES] if len(names[i]) <= CACHED_BYTES)
    flat = pa.array(found, pa.large_binary()).take(coded.indices)
    _, offsets, raw = flat.buffers()
    upto = np.frombuffer(offsets, dtype=np.int64, count=len(flat) + 1, offset=8 * flat.offset) // 4
    ids = np.frombuffer(raw, dtype=np.int32)[upto[0] : upto[-1]]
    return ids, (upto - upto[0])[np.searchsorted(bounds, marks)]


def decode_column(ids: np.ndarray, marks: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The text of each run of ids, in UTF-8.

    Control tokens give nothing, one space at the start is dropped, and a byte that is no part of a character becomes
    the replacement character. Numbers outside the vocabulary raise `IndexError`.
    """
    flat = pieces.bytes_of.take(pa.array(ids))
    _, offsets, raw = flat.buffers()
    upto = np.frombuffer(offsets, dtype=np.int64, count=len(flat) + 1, offset=8 * flat.offset)
    whole = memoryview(raw) if raw is not None else memoryview(b"")
    # control tokens part the bytes beside them; those at the end of a run part nothing
    hidden = np.concatenate(([0], np.cumsum(~pieces.visible[ids])))
    out = []
    for a, b in zip(marks[:-1].tolist(), marks[1:].tolist()):
        text = bytes(whole[upto[a] : upto[b]])
        plain = a == b or hidden[b - 1] == hidden[a]
        if plain:
            if text[:1] == b" " and pieces.normal[ids[a]]:
                text = text[1:]
            try:
                text.decode("utf-8")
            except UnicodeDecodeError:
                plain = False
        out.append(text if plain else _decode_run(ids[a:b].tolist(), pieces))
    return out


def _decode_run(ids: list[int], pieces: Pieces) -> bytes:
    """Decode one by one: each byte that belongs to no character is replaced by itself."""
    single = {t: v for v, t in enumerate(pieces.fallback.tolist())}
    out, run = bytearray(), bytearray()
    first = True

    def close() -> None:
        at = 0
        while at < len(run):
            size = next((n for n in (1, 2, 3, 4) if _one_character(bytes(run[at : at + n]))), 0)
            out.extend(run[at : at + size] if size else "\ufffd".encode())
            at += max(size, 1)
        run.clear()

    for i in ids:
        if i in single:
            run.append(single[i])
        else:
            close()
            text = pieces.bytes_of[i].as_py()
            out.extend(text[1:] if first and text[:1] == b" " and pieces.normal[i] else text)
        first = first and not pieces.visible[i]
    close()
    return bytes(out)


def _one_character(raw: bytes) -> bool:
    try:
        return len(raw.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


def encode_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: bool = True, digests: bool = True) -> DataFrame:
    """Per row of `docs`: the key, `n_tokens`, and either digests or the real outputs.

    Ids are those of the SentencePiece model at `path`, with its end id at the end if `end`, and without sampling. With
    `digests`, `ids_sha256` is the SHA-256 of the decimal ids joined by one space and `decoded_sha256` that of the
    decoded text, both in lower-case hex; without, `ids` is the list of ids and `decoded` the decoded text. A null or
    empty text has the end id only and an empty decoded text. Keys may be null or repeated: each row gives one row.
    Other columns are not read. An empty table gives an empty result. The length of a text is not limited.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        cache = _caches.setdefault(path, {})
        decimals = pa.array([b"%d " % i for i in range(len(pieces.visible))], pa.large_binary())
        for batch in short_batches(batches, 1):
            ids, marks = encode_column(batch.column(1), pieces, cache)
            if end:
                marks_with = marks + np.arange(len(marks))
                full = np.full(len(ids) + len(marks) - 1, pieces.end, dtype=np.int32)
                inside = np.ones(len(full), dtype=bool)
                inside[marks_with[1:] - 1] = False
                full[inside] = ids
                ids, marks = full, marks_with
            decoded = decode_column(ids, marks, pieces)
            if digests:
                flat = decimals.take(pa.array(ids))
                _, offsets, raw = flat.buffers()
                upto = np.frombuffer(offsets, dtype=np.int64, count=len(flat) + 1, offset=8 * flat.offset)[marks].tolist()
                whole = memoryview(raw) if raw is not None else memoryview(b"")
                first = [hashlib.sha256(whole[a : max(a, b - 1)]).hexdigest() for a, b in zip(upto, upto[1:])]
                second = [hashlib.sha256(d).hexdigest() for d in decoded]
            else:
                first = pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(ids, pa.int32()))
                second = [d.decode("utf-8") for d in decoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(marks), pa.int64()), pa.array(first, pa.string()) if digests else first, pa.array(second, pa.string())],
                names=[key, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))],
            )

    kind = docs.schema[key].dataType.simpleString()
    outputs = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    narrow = docs.select(F.col(key), F.col(text).cast("string"))
    return narrow.mapInArrow(work, f"`{key}` {kind}, n_tokens long, {outputs}")
