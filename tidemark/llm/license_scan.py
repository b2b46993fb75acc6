"""License mentions and notices by diagonal voting.

Every text is turned into words and every two consecutive words into a 64-bit hash. All these hashes are joined with
the positions that templates have them at; a hit votes for the diagonal place in the text less place in the template.
Votes are summed per text, template and diagonal before anything is shuffled. Then neighbouring diagonals of a template
are merged, since an inserted or missing word moves the rest by one, and every stretch of the merged places as long as a
notice may be is verified: it must cover enough of the template's positions. Stray places beside a notice, or a second
notice next to it, take nothing from it. A phrase of the base list must lie on one diagonal whole.

Templates are a fixed list of a few hundred positions, so their side of the join is broadcast. The long texts of a
batch are sliced by bytes; nothing is capped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import ALPHANUMERIC, flat_texts, list_array, lower_ascii, run_hashes, short_batches, slices, span_hashes, word_spans
from tidemark.llm.common import with_row_key

GRAM = 2
#: Diagonals at most this far apart belong to one span.
NEAR = 3
#: Share of a notice's positions that a span must cover, and how much longer than the notice it may be. Short notices
#: differ in a word only, so they must be covered whole.
COVER = 0.75
SHORT = 12
STRETCH = 1.3

# fixed values: phrases of the contract
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# fixed values: opening words of public notices
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("gnu lesser general public license", "lgpl"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-text"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-notice"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
]


@dataclass
class Template:
    words: int
    label: str
    base: bool


def template_rows() -> tuple[list[Template], list[tuple[int, int, int]]]:
    """The templates, and hash, template and position of each of their word pairs."""
    templates, rows = [], []
    for base, group in ((True, BASE), (False, NOTICES)):
        for phrase, label in group:
            data = np.frombuffer(phrase.encode("utf-8"), dtype=np.uint8)
            starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALPHANUMERIC)
            hashes = run_hashes(span_hashes(data, starts, ends), GRAM).view(np.int64)
            rows += [(int(h), len(templates), at) for at, h in enumerate(hashes)]
            assert len(starts) <= 60, "votes are bits of a long"
            templates.append(Template(len(starts), label, base))
    return templates, rows


def word_grams(rows: DataFrame) -> DataFrame:
    """Per row of `rid`, `doc_id`, `text`: number of words and the hashes of all runs of `GRAM` words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 2):
            data, marks = flat_texts(batch.column(2))
            for first, last in slices(marks):
                part = lower_ascii(data[marks[first] : marks[last]])
                starts, ends, bounds = word_spans(part, marks[first : last + 1] - marks[first], ALPHANUMERIC)
                words = np.diff(bounds)
                hashes = run_hashes(span_hashes(part, starts, ends), GRAM)
                owner = np.repeat(np.arange(last - first), words)
                inside = owner[: len(hashes)] == owner[len(owner) - len(hashes) :]
                grams = list_array(hashes[inside].view(np.int64), np.maximum(words - GRAM + 1, 0), pa.int64())
                rest = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [rest.column(0), rest.column(1), pa.array(words, pa.int64()), grams], names=["rid", "doc_id", "n_words", "grams"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"rid long, doc_id {kind}, n_words long, grams array<long>")


def best_spans(hits: list[tuple[int, int]], template: Template) -> list[tuple[int, int, float]]:
    """First and last word and coverage of the spans of a template that its `hits`, places and positions, verify.

    Every place with a hit begins a window as long as a notice may be, cut at the last place that adds to its coverage.
    Of windows that cover enough and share words, the one that covers most counts; then the shortest, then the first.
    So a stray hit beside a notice takes nothing from it. A window holds few places, so the work is linear in the hits.
    """
    pairs, reach = template.words - GRAM + 1, int(STRETCH * template.words)
    enough = (COVER if template.words >= SHORT else 1) * pairs
    hits = sorted(hits)
    windows = []
    for i, (start, _) in enumerate(hits):
        if i and hits[i - 1][0] == start:
            continue
        seen, end = 0, start
        for place, at in (hits[j] for j in range(i, len(hits))):
            if place + GRAM - start > reach:
                break
            if not seen >> at & 1:
                seen, end = seen | 1 << at, place + GRAM - 1
        if seen.bit_count() >= enough:
            windows.append((-seen.bit_count(), end - start, start))
    taken: list[tuple[int, int, float]] = []
    for covered, length, start in sorted(windows):
        after = bisect_left(taken, (start,))
        clear_before = after == 0 or taken[after - 1][1] < start
        clear_after = after == len(taken) or taken[after][0] > start + length
        if clear_before and clear_after:
            taken.insert(after, (start, start + length, -covered / pairs))
    return taken


def spans_of(votes: list[dict], templates: list[Template]) -> list[tuple[int, int, int, float]]:
    """Template, first and last word, and coverage of the verified spans; votes are bits of a template's positions."""
    found = []
    by: dict[int, list[dict]] = {}
    for v in votes:
        by.setdefault(v["template"], []).append(v)
    for t, own in by.items():
        template = templates[t]
        pairs = template.words - GRAM + 1
        own.sort(key=lambda v: v["diagonal"])
        if template.base:
            found += [(t, v["diagonal"], v["diagonal"] + template.words - 1, 1.0) for v in own if v["votes"].bit_count() == pairs]
            continue
        near: list[tuple[int, int]] = []
        for v, following in zip(own, [*own[1:], None], strict=True):
            near += [(v["diagonal"] + at, at) for at in range(pairs) if v["votes"] >> at & 1]
            # places on one diagonal are at most a template apart, so a jump along the text ends the neighbourhood as well
            if following is None or following["diagonal"] - v["diagonal"] > NEAR:
                found += [(t, *span) for span in best_spans(near, template)]
                near = []
    return found


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: the key as `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, labels, score and spans.

    Words are runs of digits, letters and characters outside ASCII after lower-casing A-Z. `n_base` counts the places of
    the base phrases, `first_word` and `last_word` are their least and largest start (null without one). `base_labels`
    are the labels of those phrases; `labels` adds those of verified notices; both are distinct, sorted and joined by
    commas, empty without one. `score` is the best coverage of a verified span, 0 without one. `spans` lists label,
    first and last word of each. A null or empty text has no words and no places. Null or repeated keys give a row each;
    other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    templates, positions = template_rows()
    known = F.broadcast(spark.createDataFrame(positions, "gram long, template int, at int"))
    rows = with_row_key(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), "rid")
    grams = word_grams(rows.select("rid", "doc_id", "text")).select("rid", "doc_id", "n_words", F.posexplode_outer("grams").alias("pos", "gram"))
    votes = (
        grams.join(known, "gram", "left")
        .filter("template is not null or pos is null or pos = 0")
        .groupBy("rid", "doc_id", "n_words", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("votes"))
    )
    vote = F.when(F.col("template").isNotNull(), F.struct("template", "diagonal", "votes"))
    texts = votes.groupBy("rid", "doc_id", "n_words").agg(F.collect_list(vote).alias("votes"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for own in batch.column(2).to_pylist():
                spans = sorted(spans_of(own, templates), key=lambda s: (s[1], s[2], s[0])) if own else []
                base = [s for s in spans if templates[s[0]].base]
                out["n_base"].append(len(base))
                out["first_word"].append(min((s[1] for s in base), default=None))
                out["last_word"].append(max((s[1] for s in base), default=None))
                out["base_labels"].append(",".join(sorted({templates[s[0]].label for s in base})))
                out["labels"].append(",".join(sorted({templates[s[0]].label for s in spans})))
                out["score"].append(max((s[3] for s in spans), default=0.0))
                out["spans"].append([f"{templates[s[0]].label}:{s[1]}-{s[2]}" for s in spans])
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True))],
                names=["doc_id", "n_words", *out],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "n_words", "votes").mapInArrow(
        work,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<string>",
    )
