"""Line, passage and near-copy operators, decontamination and license scan against plain references."""

import random
import re

import numpy as np
import pytest
from helpers import LOW, documents, jaccard_groups, line_cuts, sentence_cuts, store, words

import corpus_pipeline
from tidemark.llm import decontaminate, license_scan, parity_join
from tidemark.llm.components import components
from tidemark.llm.decontaminate import contaminated_pairs, without_items
from tidemark.llm.license_scan import BASE, scan_licenses
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.parity_join import jaccard_components, one_of_each
from tidemark.llm.queries import QUERIES
from tidemark.llm.sentence_dedup import cut_long, dedup_sentences

nulls = lambda rows: sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def near_copies(seed=4, n=60):
    """Texts of many lengths with copies that have some words changed, nulls, blanks, short texts and repeated keys."""
    chance = random.Random(seed)
    voc = [a + b for a in "kltmnp" for b in ("a", "e", "io", "u")]
    rows = []
    for base in range(n // 6):
        body = [chance.choice(voc) + chance.choice(voc) for _ in range(chance.choice([1, 3, 5, 6, 9, 14, 40, 130, 400]))]
        for copy in range(6):
            own = list(body)
            for _ in range(chance.choice([0, 0, 1, 1, 2, max(1, len(own) // 60), max(1, len(own) // 45)])):
                own[chance.randrange(len(own))] = chance.choice(voc) + "x"
            rows.append((len(rows), " ".join(own).upper() if copy == 5 else " ".join(own)))
    return rows + [(900, None), (901, ""), (902, " \n\t"), (None, rows[0][1]), (3, "again the third key")]


def test_components_by_alternating_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[100] == 50 and found[201] == 200 and 7 in found
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("spare", [1.0, 1.15, 3.0])
def test_near_copies_equal_all_pairs(spark, tmp_path, monkeypatch, spare):
    monkeypatch.setattr(parity_join, "SPARE", spare)
    rows = near_copies()
    found = [tuple(r) for r in jaccard_components(store(spark, tmp_path, rows, files=1)).collect()]
    assert nulls(found) == nulls(jaccard_groups(rows))


def test_signatures_meet_for_every_linked_pair():
    """Two sets at the limit share a signature, whatever the sizes."""
    import numpy as np

    chance = np.random.default_rng(3)
    for size in [1, 2, 4, 5, 8, 9, 15, 16, 17, 33, 64, 127, 128, 300, 1000]:
        for _ in range(6):
            a = np.unique(chance.integers(0, 1 << 62, size, dtype=np.int64).astype(np.uint64))
            lost = int(chance.integers(0, size // 9 + 1))
            new = np.unique(chance.integers(0, 1 << 62, int(chance.integers(0, size // 9 + 1)), dtype=np.int64).astype(np.uint64))
            b = np.unique(np.concatenate([a[lost:], new]))
            if 100 * (len(a) - lost) < 80 * len(np.union1d(a, b)):
                continue
            owner = np.repeat([0, 1], [len(a), len(b)])
            who, sign = parity_join.signatures(owner, np.concatenate([a, b]), 2)
            assert set(sign[who == 0]) & set(sign[who == 1]), (size, lost, len(new))


def test_a_large_group_of_copies_and_one_of_near_copies(spark, tmp_path):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, "the same text for a third of all rows in this table") for i in range(150)]
    rows += [(1000 + i, " ".join([*base[:i], f"v{i}", *base[i + 1 :]])) for i in range(120)]
    rows += [(5000 + i, f"{i} alone {i * 7} with words {i * 11} of its {i * 13} own {i * 17}") for i in range(150)]
    assert nulls(map(tuple, jaccard_components(store(spark, tmp_path, rows)).collect())) == nulls(jaccard_groups(rows))


def test_one_of_each_group_stays_with_all_columns(spark, tmp_path):
    rows = [r for r in near_copies(8) if r[1] != "again the third key"]
    docs = store(spark, tmp_path, [(*r, "x", 1) for r in rows], "doc_id long, text string, rid string, n int")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    groups = jaccard_groups(rows)
    wanted = {g[2] for g in groups if g[1]} | {900, 901, 902}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    assert one_of_each(docs.limit(0)).collect() == []


@pytest.mark.parametrize("least", [1, 6, 20])
def test_line_runs(spark, tmp_path, least):
    chance = random.Random(least)
    voc = ["a", "bb", "ccc", "a long line of text here", "x y", "", "  ", "another quite long line", "é", "short"]
    rows = [(None if chance.random() < 0.1 else i % 90, "\n".join(chance.choice(voc) for _ in range(chance.randint(0, 12)))) for i in range(110)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "one line\r\none line\r\n" * 200), (504, "é" * 5000), (505, "é" * 5000)]
    docs = store(spark, tmp_path, [(*r, 1, 2) for r in rows], "doc_id long, text string, lines_removed int, rid int")
    found = dedup_lines(docs, least_chars=least)
    assert found.columns == [*docs.columns, "lines_removed_", "lines_left"]
    assert nulls((r.doc_id, r.text, r.lines_removed_, r.lines_left) for r in found.collect()) == nulls(line_cuts(rows, least))
    assert dedup_lines(docs.limit(0)).collect() == []


def all_line_runs(rows, least):
    """Lines removed from every row, with all runs of at least `least` bytes looked up in reading order."""
    seqs = [[x for x in (t or "").split("\n") if x.strip(" \t\r\x0b\x0c")] for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)):
        for p in range(len(seqs[i])):
            size = 0
            for q in range(p, len(seqs[i])):
                size += len(seqs[i][q].encode())
                if size >= least:
                    run = tuple(seqs[i][p : q + 1])
                    if run in seen:
                        gone[i].update(range(p, q + 1))
                    seen.add(run)
    return [len(x) for x in gone]


@pytest.mark.parametrize("least", [1, 2, 6, 20, 33])
def test_whole_line_runs(spark, tmp_path, least):
    chance = random.Random(least)
    voc = ["a", "bb", "ccc", "a long line of text here", "x y", "", "  ", "another quite long line", "é", "short"]
    rows = [(None if chance.random() < 0.1 else i % 90, "\n".join(chance.choice(voc) for _ in range(chance.randint(0, 12)))) for i in range(110)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "one line\r\none line\r\n" * 40), (504, "é" * 5000), (505, "é" * 5000)]
    rows += [(600, "A line of more than twenty bytes\nLes."), (601, "A line of more than twenty bytes\n\nLes.\nOther."), (602, "Les.")]
    found = dedup_lines(store(spark, tmp_path, rows), least_chars=least, whole=True).collect()
    assert nulls((r.doc_id, r.lines_removed) for r in found) == nulls(zip([k for k, _ in rows], all_line_runs(rows, least), strict=True))
    if least == 20:
        assert {r.doc_id: r.text for r in found}[601] == "\nOther."


def test_the_line_query_leaves_no_short_last_lines(spark, tmp_path):
    text = "A line of more than twenty bytes\nLes."
    store(spark, tmp_path, [(1, text), (2, text), (3, f"{text}\nOwn.")]).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    found = {r.doc_id: (r.text, r.lines_left) for r in QUERIES["op8_line_dedup"](spark, str(tmp_path / "sf")).collect()}
    assert found == {1: (text, 2), 2: ("", 0), 3: ("Own.", 1)}
    docs = spark.read.parquet(str(tmp_path / "sf" / "documents.parquet"))
    assert sorted(r.doc_id for r in corpus_pipeline.lines(spark, docs, "").collect()) == [1, 3]


def test_lines_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    assert nulls(map(tuple, dedup_lines(documents(spark).select("doc_id", "text")).collect())) == nulls(line_cuts(rows, 20))


def test_passages(spark, tmp_path):
    chance = random.Random(6)
    voc = ["ab", "cd.", "ef,", "Gh", "ij", "kl", "mn;", "Op", "é", "Étre", "x\n"]
    passages = [" ".join(chance.choice(voc) for _ in range(9)) for _ in range(4)]
    rows = []
    for i in range(80):
        head, tail = (" ".join(chance.choice(voc) for _ in range(chance.randint(0, 10))) for _ in range(2))
        rows.append((3 if chance.random() < 0.1 else i, f"{head} {chance.choice(passages) if chance.random() < 0.6 else ''} {tail}"))
    rows += [(None, None), (None, ""), (None, passages[0]), (700, "word " * 20_000), (701, "word " * 20_000)]
    docs = store(spark, tmp_path, [(*r, "c") for r in rows], "doc_id long, text string, spans string")
    found = dedup_sentences(docs, least_words=6)
    assert found.columns == ["doc_id", "text", "spans", "words_removed", "spans_"]
    assert sorted((str(r.doc_id), r.words_removed) for r in found.collect()) == sorted(zip([str(k) for k, _ in rows], sentence_cuts(rows, 6)))
    assert dedup_sentences(docs.limit(0)).collect() == []


def test_a_passage_inside_other_sentences_stays_once(spark, tmp_path):
    chance = random.Random(1)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(6))
    sentence = lambda n: " ".join([word().capitalize(), *(word() for _ in range(n))]) + "."
    passage = " ".join(sentence(11) for _ in range(5))
    rows = [(i, f"{sentence(14)[:-1]} {passage} {word()} {sentence(9)}" if i % 3 == 0 else f"{sentence(20)} {sentence(12)}") for i in range(30)]
    found = {r.doc_id: r for r in dedup_sentences(store(spark, tmp_path, rows)).collect()}
    assert [i for i in found if passage in found[i].text] == [0]
    assert all(found[i].text == t and not found[i].spans for i, t in rows if i % 3 or i == 0)
    raw = dict(rows)[3].encode()
    assert passage.encode() in b"".join(raw[s.start : s.stop] for s in found[3].spans)


def test_passages_of_long_sentences_stay_once(spark, tmp_path):
    """Texts of one sentence, and passages of 51 words of long clauses between other words."""
    chance = random.Random(3)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    plain = text(65)
    rows = [(0, plain), (1, plain), (2, text(65))]
    passages = [", ".join([text(16), text(17), text(18)]) for _ in range(20)] + [text(51) for _ in range(20)]
    for i, passage in enumerate(passages):
        rows += [(10 + 2 * i, f"{text(chance.randint(0, 30))} {passage} {text(chance.randint(0, 30))}"), (11 + 2 * i, f"{text(5)} {passage} {text(12)}")]
    store(spark, tmp_path, rows).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    found = {r.doc_id: r for r in QUERIES["op5_sentence_dedup"](spark, str(tmp_path / "sf")).collect()}
    assert found[1].text == "" and found[1].words_removed == 65
    assert all(found[k].text == t and not found[k].spans for k, t in rows if k in (0, 2) or k % 2 == 0)
    for i, passage in enumerate(passages):
        left = found[11 + 2 * i].text.split()
        assert found[11 + 2 * i].words_removed == 68 - len(left) and set(left) >= set(rows[4 + 2 * i][1].split()) - set(passage.split())
        assert len(set(left) & set(passage.split())) <= 20, i


def test_long_sentences_are_cut_by_their_words_only():
    chance = np.random.default_rng(2)
    words = chance.integers(0, 1 << 62, 400).astype(np.uint64)
    none = np.zeros(500, dtype=bool)
    none[0] = True
    one, other = (cut_long(none, np.concatenate([words[:0], head, words, chance.integers(0, 1 << 62, 100 - len(head)).astype(np.uint64)]), 10) for head in (words[:7], words[50:93]))
    assert np.array_equal(one[7 + 9 : 7 + 391], other[43 + 9 : 43 + 391])
    assert np.diff(np.append(np.flatnonzero(one), 500)).max() <= 10
    short = np.zeros(10, dtype=bool)
    short[0] = True
    assert cut_long(short, words[:10], 10).sum() == 1 and len(cut_long(short[:0], words[:0], 10)) == 0


def test_benchmark_items_are_found_with_edits_and_clean_texts_are_not(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)  # several blocks
    chance = random.Random(2)
    word = lambda: "".join(chance.choice("aeioumnprst") for _ in range(chance.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(chance.choice([8, 12, 30, 60]))) for i in range(12)] + [(50, None), (51, ""), (52, "too short"), (53, None)]
    rows, wanted = [], set()
    for i in range(60):
        body = text(chance.randint(0, 150))
        if i % 2:
            item, passage = items[i % 12]
            letters = list(passage)
            for _ in range(len(letters) // 25):
                letters[chance.randrange(len(letters))] = "z"
            changed = "".join(letters)
            changed = changed.upper().replace(" ", " \n*") if i % 3 else changed
            rows.append((i, f"{body} {changed} {text(20)}"))
            wanted.add((i, item))
        else:
            rows.append((i, body))
    rows += [(None, None), (None, ""), (70, "É" * 40), (71, text(30_000))]
    docs = store(spark, tmp_path, [(*r, "k") for r in rows], "doc_id long, text string, item_id string")
    benchmark = store(spark, tmp_path, items, "item_id long, text string")
    found = contaminated_pairs(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted and len(found) == len(wanted)
    plain = dict(rows)
    for r in found:
        span = plain[r.doc_id].encode()[r.start_byte : r.end_byte].decode().lower()
        assert re.sub(r"\W+", " ", span).strip()[:6] in re.sub(r"\W+", " ", plain[r.doc_id].lower())
    kept = without_items(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, _ in rows if k not in {w[0] for w in wanted})
    assert contaminated_pairs(docs, benchmark.limit(0)).collect() == [] and contaminated_pairs(docs.limit(0), benchmark).collect() == []
    assert without_items(docs, benchmark.limit(0)).count() == len(rows)


def test_fragments_short_items_and_capitals_of_any_script_are_found(spark, tmp_path):
    chance = random.Random(8)
    word = lambda letters="aeioumnprst": "".join(chance.choice(letters) for _ in range(chance.randint(2, 8)))
    text = lambda n, *a: " ".join(word(*a) for _ in range(n))
    wide = text(30, "абвгдежзиклмнопрст")
    items = [(1, text(60)), (2, text(26)[:140].strip()), (3, "when was zurich founded"), (4, wide), (5, "short one")]
    rows, wanted = [], set()
    for item in (0, 1):
        whole = items[item][1]
        for at in range(len(whole) - 96 + 1):
            # a fragment from any place on, with other words around
            rows.append((len(rows), f"{text(6, 'bcdfg')} {whole[at : at + 96]} {text(6, 'bcdfg')}"))
            wanted.add((rows[-1][0], item + 1))
    planted = [
        ("He asked: When was ZURICH founded?", 3),
        ("when was zurich foundede", None),
        ("forwhen was zurich founded", None),
        ("when was zurich found", None),
        ("İİ K " + wide.upper() + " İ", 4),
        ("a short one", None),
        ("ÄÖÜ when\n\nwas, zurich founded", 3),
    ]
    for body, item in planted:
        rows.append((len(rows), body))
        if item:
            wanted.add((rows[-1][0], item))
    docs = store(spark, tmp_path, rows, "doc_id long, text string")
    found = contaminated_pairs(docs, store(spark, tmp_path, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    plain = dict(rows)
    span = {(r.doc_id, r.item_id): plain[r.doc_id].encode()[r.start_byte : r.end_byte].decode() for r in found if r.item_id in (3, 4)}
    assert {(k[1], re.sub(r"\W+", " ", v).lower()) for k, v in span.items()} == {(3, items[2][1]), (4, wide)}
    broken = docs.filter("doc_id = 0").selectExpr("doc_id", "cast(concat(cast(text as binary), X'FF20') as string) text")
    assert [(r.doc_id, r.item_id) for r in contaminated_pairs(broken, spark.createDataFrame(items, "item_id long, text string")).collect()] == [(0, 1)]


def test_whole_table_holds_the_verbatim_items(spark):
    from helpers import SF

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = lambda t: re.sub(r"[\W_]+", " ", t.lower()).strip()
    texts = [(r.doc_id, plain(r.text)) for r in documents(spark).collect()]
    wanted = {(k, b.item_id) for b in benchmark.collect() for k, t in texts if plain(b.text) in t}
    found = {(r.doc_id, r.item_id) for r in contaminated_pairs(documents(spark), benchmark).collect()}
    assert wanted and wanted <= found


def test_license_places_and_notices(spark, tmp_path):
    rows = [
        (1, "Released under the MIT License."),
        (2, "mit license mit license mit license"),
        (3, "mit. LICENSE and gnu-general public/license; Apache\nLicense cc.by"),
        (4, "licensed under CC BY-NC 4.0"),
        (5, "This work is licensed under the GNU General Public License, version 3."),
        (6, "permission is hereby granted, at no cost, free of charge to any person obtaining a copy of this software"),
        (7, None),
        (8, ""),
        (9, "mit"),
        (None, "mitlicense gnu general"),
        (9, "cc by"),
        (10, "word " * 40_000 + "apache license"),
    ]
    docs = store(spark, tmp_path, [(*r, "t", 1) for r in rows], "doc_id long, text string, template string, pos int")
    found = scan_licenses(docs).collect()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = []
    for key, text in rows:
        w = pattern.findall((text or "").translate(LOW))
        places = [(i, label) for p, label in BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        wanted.append((key, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    assert nulls(tuple(r)[:6] for r in found) == nulls(wanted)
    by = {r.doc_id: r for r in found if r.doc_id != 9}
    assert by[1].labels == "mit,mit-notice" and by[4].labels == "cc-by,cc-by-nc-4.0" and by[5].labels == "gpl,gpl-3.0"
    assert by[2].labels == "mit" and by[6].labels == "mit-text" and 0.75 <= by[6].score < 1 and by[7].score == 0.0
    assert all(0 <= r.score <= 1 for r in found)
    assert scan_licenses(docs.limit(0)).collect() == []
    assert len(license_scan.template_rows()[1]) < 300
    assert words("A b") == ["a", "b"]


def notice_scores(sequence):
    """Best coverage of every notice over all stretches of the words, by enumeration; only those that suffice."""
    found = {}
    for phrase, label in license_scan.NOTICES:
        t = phrase.split()
        pairs = len(t) - 1
        hits = [(i, at) for i in range(len(sequence) - 1) for at in range(pairs) if sequence[i : i + 2] == t[at : at + 2]]
        diagonals = sorted({i - at for i, at in hits})
        groups = np.cumsum([0, *(b - a > license_scan.NEAR for a, b in zip(diagonals, diagonals[1:]))]) if diagonals else []
        group = dict(zip(diagonals, groups, strict=True))
        for first in range(len(sequence)):
            for g in set(group.values()):
                inside = {at for i, at in hits if first <= i and i + 2 <= first + int(license_scan.STRETCH * len(t)) and group[i - at] == g}
                if len(inside) >= (license_scan.COVER if len(t) >= license_scan.SHORT else 1) * pairs:
                    found[label] = max(found.get(label, 0), len(inside) / pairs)
    return found


def test_notices_equal_an_enumeration(spark, tmp_path):
    chance = random.Random(8)
    texts = [
        "Released under the released under the MIT License.",
        "licensed under licensed under cc by 4 0",
        "released under the mit license " * 3,
        "mit license released under the mit license under the mit license",
        "under the gnu general public license redistribute it and you can redistribute it and or modify it under the terms of the gnu general public license",
    ]
    for _ in range(150):
        out = []
        for _ in range(chance.randint(1, 4)):
            t = chance.choice(license_scan.NOTICES)[0].split()
            a = chance.choice([0, 0, chance.randrange(len(t))])
            part = t[a : chance.choice([len(t), len(t), chance.randint(a, len(t))])]
            if part and chance.random() < 0.3:
                part.insert(chance.randrange(len(part)), chance.choice(["x", *t]))
            out += part + ["y"] * chance.choice([0, 0, 1, 3, 30])
        texts.append(" ".join(out))
    docs = store(spark, tmp_path, list(enumerate(texts)))
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    base = {label for _, label in BASE}
    for i, text in enumerate(texts):
        wanted = notice_scores([w.strip(".").lower() for w in text.split()])
        labels = set(filter(None, got[i].labels.split(","))) - base
        assert labels == set(wanted), text
        if wanted and not got[i].base_labels:
            assert abs(got[i].score - max(wanted.values())) < 1e-12
    assert got[0].labels == "mit,mit-notice" and got[1].labels == "cc-by,cc-by-4.0"
    assert sum(s.startswith("mit-notice:") for s in got[2].spans) == 3
    assert "gpl-notice" in got[4].labels and got[4].score == 1.0
