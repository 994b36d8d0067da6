"""The pipeline's stages against brute force, each on its own input, over the smallest test data."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from botpulse.llm import decontaminate, mixing, quality

from .test_bruteforce import brute_classes, deleted_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    """The smallest test data and, as the line dedup leaves none of its copies, near copies written as one line: those of the first
    20 documents of 80 words and several lines, with the word in the middle changed."""
    folder = tmp_path_factory.mktemp("tables")
    docs = pq.read_table(f"{SF}/documents.parquet")
    long = [r for r in docs.to_pylist() if len((r["text"] or "").split()) >= 80 and "\n" in r["text"].strip()]
    copies = []
    for i, r in enumerate(long[:20]):
        words = r["text"].split()
        words[len(words) // 2] = "other"
        text = " ".join(words)
        copies.append(r | {"doc_id": 1_000_000 + i, "text": text, "n_chars": len(text)})
    pq.write_table(pa.concat_tables([docs, pa.Table.from_pylist(copies, docs.schema)]), folder / "documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/benchmark.parquet"), folder / "benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def outputs(spark, sf, tmp_path_factory):
    """The rows before the first and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = [[r.asDict() for r in docs.collect()]]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        found.append([r.asDict() for r in docs.collect()])
    return found


def _shares(row):
    profile = row["lang"] if row["lang"] in quality.COMMON_WORDS else quality.OTHER
    n, _, _, _, repeated, classes, common = quality.features(row["text"] or "", profile)
    return profile, n, n < 10 or 100 * repeated > 20 * n, classes, common


def _distance(p, q):
    if not sum(p) or not sum(q):
        return 0.0
    total = 0.0
    for a, b in zip(p, q):
        a, b = a / sum(p), b / sum(q)
        total += (a * math.log2(2 * a / (a + b)) if a else 0) / 2 + (b * math.log2(2 * b / (a + b)) if b else 0) / 2
    return math.sqrt(max(total, 0.0))


def test_quality(outputs):
    rows = [(r, *_shares(r)) for r in outputs[0]]
    sound = [x for x in rows if not x[3] and x[2] >= 20]

    def kept(x, references):
        _, profile, n, failed, classes, common = x
        reference = references.get(profile, ([], []))
        return not (failed or (n >= 20 and _distance(classes, reference[0]) > 0.175)
                    or (n >= 100 and common and _distance(common, reference[1]) > 0.33))

    def summary(of, function):
        return {p: tuple([function([x[k][i] for x in of if x[1] == p and x[k]]) for i in range(width)]
                         if any(x[1] == p and x[k] for x in of) else []
                         for k, width in ((4, 9), (5, 26))) for p in {x[1] for x in of}}

    first = summary(sound, lambda v: float(np.median([s // quality.STEP for s in v])))
    second = first | summary([x for x in sound if kept(x, first)], lambda v: float(sum(v)))
    assert sorted(r["doc_id"] for r in outputs[1]) == sorted(x[0]["doc_id"] for x in rows if kept(x, second))
    assert {(r["doc_id"], r["text"]) for r in outputs[1]} <= {(r["doc_id"], r["text"]) for r in outputs[0]}


def test_line_dedup(outputs):
    expected = {}
    body = {r["doc_id"]: [(n, s.strip(" \t\n\x0b\x0c\r")) for n, s in enumerate(r["text"].split("\n"))
                          if s.strip(" \t\n\x0b\x0c\r")] for r in outputs[1]}
    found = deleted_lines([(i, [s for _, s in body[i]]) for i in sorted(body)])
    for r in outputs[1]:
        i = r["doc_id"]
        gone = {body[i][k][0] for k in found[i]}
        text = "\n".join(s for n, s in enumerate(r["text"].split("\n")) if n not in gone)
        if not gone or text.split():
            expected[i] = (text, len(text) if gone else r["n_chars"])
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in outputs[2]} == expected
    assert expected != {r["doc_id"]: (r["text"], r["n_chars"]) for r in outputs[1]}


def test_near_dedup(outputs):
    classes = brute_classes([(r["doc_id"], r["text"]) for r in outputs[2]])
    assert sorted(r["doc_id"] for r in outputs[3]) == sorted(set(classes.values()))
    assert len(outputs[3]) < len(outputs[2])


def _template(text):
    for a in "\t\n\x0b\x0c\r-/":
        text = text.replace(a, " ")
    for a in decontaminate._DELETED:
        text = text.replace(a, "")
    words = [w for w in text.split(" ") if w]
    return words, [1 if "0" <= w[0] <= "9" else 2 if w.lower() != w else 3 if w in decontaminate.UNITS else w for w in words]


def _leaks(text, item):
    words, codes = _template(text)
    item_words, item_codes = item
    places = {}
    for p in range(len(codes) - 7):
        places.setdefault(tuple(codes[p:p + 8]), []).append(p)
    hits = {}
    for q in range(len(item_codes) - 7):
        window = tuple(item_codes[q:q + 8])
        if sum(isinstance(c, str) for c in window) >= 4:
            for p in places.get(window, ()):
                hits.setdefault(p - q, set()).update(range(q, q + 8))
    for offset, covered in hits.items():
        pairs = [(item_codes[q], item_words[q], words[q + offset]) for q in covered if not isinstance(item_codes[q], str)]
        clash = sum(any(a[0] == b[0] and (a[1] == b[1]) != (a[2] == b[2]) for b in pairs) for a in pairs)
        if (len(covered) >= 13 or len(covered) >= 0.5 * len(item_codes)) and (not pairs or 1 - clash / len(pairs) >= 0.75):
            return True
    return False


def test_decontamination(spark, sf, outputs):
    items = [_template(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in outputs[3] if not any(_leaks(r["text"], item) for item in items)]
    assert sorted(r["doc_id"] for r in outputs[4]) == sorted(clean)


def test_mixing(spark, outputs):
    topics = {}
    for r in outputs[4]:
        t = r["text"]
        topics[r["doc_id"]] = ("legal" if "icense" in t else "contact" if "@" in t or "555-" in t else "tabular" if " | " in t
                               else "long" if len(t.encode()) >= 8000 else "prose")
    cells = Counter()
    for r in outputs[4]:
        cells[r["source"], r["lang"], topics[r["doc_id"]]] += max(1, math.ceil(len(r["text"].encode()) / 4))
    keys = sorted(cells)
    tokens = np.array([cells[k] for k in keys], float)
    weights, targets = tokens / tokens.sum(), []
    for d in range(3):
        sums = Counter()
        for k in keys:
            sums[k[d]] += cells[k]
        whole = sum(v ** 0.5 for v in sums.values())
        targets.append({v: s ** 0.5 / whole for v, s in sums.items()})
    for _ in range(mixing.ROUNDS):
        for d in range(3):
            now = Counter()
            for k, w in zip(keys, weights):
                now[k[d]] += w
            weights = np.array([w * targets[d][k[d]] / now[k[d]] for k, w in zip(keys, weights)])
    ratio = weights / weights.sum() / tokens
    low, high = 0.0, 1 / ratio.min()
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (tokens * np.minimum(1, middle * ratio)).sum() < 0.5 * tokens.sum() else (low, middle)
    p = dict(zip(keys, np.minimum(1, high * ratio)))
    for r in outputs[5]:
        assert r["probability"] == pytest.approx(p[r["source"], r["lang"], topics[r["doc_id"]]], rel=1e-4)
    ids = {r["doc_id"] for r in outputs[5]}
    assert ids < {r["doc_id"] for r in outputs[4]}
    assert {r["doc_id"] for r in outputs[4] if p[r["source"], r["lang"], topics[r["doc_id"]]] >= 1} <= ids


def test_run_is_the_stages_in_order(spark, sf, outputs):
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(str, (r.asDict() for r in got))) == sorted(map(str, outputs[5]))
