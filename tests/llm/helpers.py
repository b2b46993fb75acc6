"""Small tables and plain references for the tests of the operators."""

import itertools
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
_serial = itertools.count()


def store(spark, tmp_path, rows, schema="doc_id long, text string", files=1):
    """A stored table of the rows, in that order if in one file."""
    path = str(tmp_path / f"table-{next(_serial)}")
    spark.createDataFrame(rows, schema).coalesce(files).write.parquet(path)
    return spark.read.parquet(path)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard_groups(rows):
    """Size and smallest reachable key of every row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(keys, default=None)))
    return out


def line_cuts(rows, least):
    """Text, lines removed and left of every row, with windows looked up in reading order."""
    seqs = [[x for x in (t or "").split("\n") if x.strip(" \t\r\x0b\x0c")] for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, gone = set(), [set() for _ in rows]
    for i in order:
        for p in range(len(seqs[i])):
            size = n = 0
            while size < least and p + n < len(seqs[i]):
                size += len(seqs[i][p + n].encode())
                n += 1
            run = tuple(seqs[i][p : p + n])
            if size >= least:
                if run in seen:
                    gone[i].update(range(p, p + n))
                seen.add(run)
    out = []
    for i, (key, text) in enumerate(rows):
        kept, at = [], 0
        for line in (text or "").split("\n"):
            full = bool(line.strip(" \t\r\x0b\x0c"))
            if not (full and at in gone[i]):
                kept.append(line)
            at += full
        out.append((key, None if text is None else "\n".join(kept), len(gone[i]), len(seqs[i]) - len(gone[i])))
    return out


def sentence_cuts(rows, least, run=2):
    """Words cut from every row, with all runs looked up in reading order."""
    capital = lambda w: 65 <= w[0] <= 90 or (w[0] == 0xC3 and len(w) > 1 and 0x80 <= w[1] <= 0x9E)
    parsed = []
    for _, text in rows:
        raw = (text or "").encode()
        found = [(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
        starts = [
            i
            for i, (a, _, w) in enumerate(found)
            if i == 0
            or found[i - 1][2][-1] in b"!,.:;?"
            or b"\n" in raw[found[i - 1][1] : a]
            or (capital(w) and not capital(found[i - 1][2]))
        ]
        parsed.append(([w for _, _, w in found], [*starts, len(found)]))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, cut = set(), [set() for _ in rows]
    for i in order:
        w, edge = parsed[i]
        for x in range(len(edge) - 1):
            for y in range(x + run, len(edge)):
                if edge[y] - edge[x] >= least:
                    key = tuple(w[edge[x] : edge[y]])
                    if key in seen:
                        cut[i].update(range(edge[x], edge[y]))
                    seen.add(key)
    return [len(c) for c in cut]
