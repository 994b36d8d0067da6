"""Every operator against a brute-force version on small hand-made and random tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from botpulse.llm import (
    dart_minhash, decontaminate, license_scan, line_dedup, mixing, pii, quality, secrets, substring_dedup, token_counts)
from botpulse.llm.fm_index import FMIndex, _Bits

WORD = r"[^\x20\x09-\x0D]+"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


# 1 line dedup

def test_line_dedup(spark):
    rnd = random.Random(1)
    rows = [(i, "\n".join(rnd.choice(["a", "b", " b", "c ", "", "d", "e"]) for _ in range(rnd.randrange(0, 14))))
            for i in range(120)]
    first: dict[tuple, tuple] = {}
    expected = {}
    split = {i: [(n, s.strip(" \t\n\x0b\x0c\r")) for n, s in enumerate(t.split("\n")) if s.strip(" \t\n\x0b\x0c\r")]
             for i, t in rows}
    for i, _ in rows:
        for k in range(len(split[i]) - 2):
            first.setdefault(tuple(s for _, s in split[i][k:k + 3]), (i, k))
    for i, t in rows:
        gone = set()
        for k in range(len(split[i]) - 2):
            if first[tuple(s for _, s in split[i][k:k + 3])] != (i, k):
                gone |= {split[i][k + o][0] for o in range(3)}
        expected[i] = ("\n".join(s for n, s in enumerate(t.split("\n")) if n not in gone), len(gone))
    got = {r.doc_id: (r.kept_text, r.n_removed) for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got == expected
    assert any(n for _, n in expected.values())


def deleted_lines(bodies, run=3, words=8):
    """Line numbers that go, per document: bodies are (key, stripped lines) in the order of places."""
    first: dict[tuple, tuple] = {}
    gone = {i: set() for i, _ in bodies}
    for i, body in bodies:
        for k in range(len(body)):
            for n in range(1, run + 1):
                part = tuple(body[k:k + n])
                if len(part) == n and (n == run or sum(len(re.findall(WORD, s)) for s in part) >= words):
                    if first.setdefault(part, (i, k)) != (i, k):
                        gone[i] |= set(range(k, k + n))
    return gone


@pytest.mark.parametrize("run, words", [(3, 8), (2, 4), (4, 6), (1, 1)])
def test_line_dedup_by_words(spark, run, words):
    rnd = random.Random(run)
    pool = ["a", "b c", " d e f", "g h i j ", "k l m n o p", "q r s t u v w x y", "z " * 9, "", "\u00a0 \u2003 x"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else f"own {rnd.random()} line" for _ in range(rnd.randrange(0, 12))))
            for i in range(150)]
    bodies = [(i, [s for line in t.split("\n") if (s := line.strip(" \t\n\x0b\x0c\r"))]) for i, t in rows]
    gone = deleted_lines(bodies, run, words)
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, rows), run=run, words=words).collect()}
    for i, body in bodies:
        kept = [s for line in got[i].kept_text.split("\n") if (s := line.strip(" \t\n\x0b\x0c\r"))]
        assert got[i].n_removed == len(gone[i]) and kept == [s for k, s in enumerate(body) if k not in gone[i]]
    assert any(gone.values())


def test_passage_written_as_one_line_and_pairs_of_lines(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage), (2, f"new\n{passage}\nend"), (3, "five words are in here\nand four in here"),
            (4, "five words are in here\nand four in here\nmore"), (5, "short line"), (6, "short line")]
    got = {r.doc_id: (r.kept_text, r.n_removed) for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got[2] == ("new\nend", 1) and got[4] == ("more", 2) and got[6] == ("short line", 0)
    assert got[1][1] == got[3][1] == got[5][1] == 0


def test_line_dedup_edits_by_one_python_worker_a_task(spark):
    """A filter on the edited texts doesn't edit them a second time, and only texts of which no line is left go."""
    rows = [(1, "one two three four five six seven eight\nown words"), (2, "one two three four five six seven eight"),
            (3, "before\none two three four five six seven eight\nafter"), (4, None), (5, " \n"), (None, "alone"), (6, "own")]
    kept = line_dedup.deduplicated(frame(spark, rows))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython ") == 1
    assert {(r.doc_id, r.text) for r in kept.collect()} == {
        rows[0], (3, "before\nafter"), (4, None), (5, " \n"), (None, "alone"), (6, "own")}


def test_fingerprints_are_fewer_than_windows_and_in_every_window():
    h = np.random.default_rng(4).integers(0, 2 ** 63, 3000).astype(np.uint64)
    at = line_dedup.fingerprints(h, np.ones(3000, np.int64), 3, 8)
    assert np.diff(np.concatenate([[-1], at, [3000]])).max() <= 3
    assert len(at) < 0.6 * 3000
    assert len(line_dedup.fingerprints(h[:2], np.ones(2, np.int64), 3, 8)) == 0


# 2 quality

def test_quality_base_figures():
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "b", " ", "\n", "é", "#", " ", "\x1c", " a b c d e", "\t", "x|", "1"])
                       for _ in range(rnd.randrange(0, 60)))
        words = re.findall(WORD, text)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        counts = Counter(windows)
        covered = {i + o for i, w in enumerate(windows) if counts[w] > 1 for o in range(5)}
        lines = [s for s in text.split("\n") if re.search(WORD, s)]
        n, chars, symbols, dup, repeated, classes, common = quality.features(text, "en")
        assert (n, chars, dup, repeated) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered))
        assert symbols == len(re.findall(r"[#*$%&|<>]", text))


def test_jensen_shannon():
    p, q = np.array([[1.0, 0, 0], [1, 1, 0], [2, 2, 4]]), np.array([[0, 1.0, 0], [1, 1, 0], [1, 1, 2]])
    assert np.allclose(quality.jensen_shannon(p, q), [1, 0, 0])


def test_quality_keeps_by_one_python_worker_a_task(spark):
    """Figures and distances come from one Python evaluation, and the rows kept are those of the rules."""
    rnd = random.Random(3)
    rows = [(i, "en" if i % 3 else "xx", " ".join(rnd.choice(quality.COMMON_WORDS["en"]) if rnd.random() < 0.4 else
                                                 "".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(rnd.randrange(5, 160))))
            for i in range(60)]
    rows += [(100 + i, "en", "#{}!! %%0x&& " * (20 + i)) for i in range(5)] + [(200, None, None), (201, "en", "")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = quality.keep_quality(df)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython ") == 1
    found = {r.doc_id for r in kept.collect()}
    assert found == {r.doc_id for r in quality.quality_rules(df).collect() if r.kept} and 0 < len(found) < 60


def test_quality_rejects_junk_and_keeps_prose(spark):
    rnd = random.Random(3)
    letters = "etaoinshrdlu"

    def prose(n):
        return " ".join(rnd.choice(quality.COMMON_WORDS["en"]) if rnd.random() < 0.4 else
                        "".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 8))) for _ in range(n))

    good = [(i, prose(200), "en") for i in range(60)]
    junk = [(100 + i, prose(200).upper().replace(" ", "!! "), "en") for i in range(10)]
    junk += [(200 + i, " ".join(w + "###" for w in prose(200).split()), "en") for i in range(10)]
    df = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(df).collect()}
    assert {i for i, k in kept.items() if k} == {i for i, _, _ in good}


# 3 secrets

def entropy(word, window=secrets.WINDOW):
    return max(sum(-c / window * math.log2(c / window) for c in Counter(word[i:i + window]).values())
               for i in range(len(word) - window + 1))


def brute_secrets(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    out = list(base)
    for m in re.finditer(r"[A-Za-z0-9+/_-]+", text):
        w = m[0]
        if len(w) < secrets.WINDOW or not re.search("[0-9]", w) or not re.search("[A-Za-z]", w):
            continue
        if any(re.search(p, w) for p in secrets.ALLOWED):
            continue
        bits = next(b for p, b in secrets.CLASSES if re.search(p, w))
        if entropy(w) >= bits - 1e-9 and not any(a < m.end() and m.start() < b for a, _, b in base):
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_secrets(spark):
    rnd = random.Random(4)
    b64 = "ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/_-"

    def piece():
        return rnd.choice([
            "".join(rnd.choice("abcdef0123456789") for _ in range(rnd.randrange(1, 50))),
            "AKIA" + "".join(rnd.choice("ABCZ019") for _ in range(rnd.randrange(1, 30))),
            'Token = "' + "".join(rnd.choice(b64) for _ in range(rnd.randrange(1, 12))) + '"',
            "".join(rnd.choice(b64) for _ in range(rnd.randrange(1, 60))),
            "hélloé😀", "the", "API_KEY:", "secret=token:abcdefgh", "\n", "password=token=abc", "a" * 28 + "1111",
            "123e4567-e89b-12d3-a456-426614174000", "EXAMPLEKEY0123987654zyxw"])

    rows = [(i, rnd.choice([" ", "", " "]).join(piece() for _ in range(rnd.randrange(0, 12)))) for i in range(300)]
    rows += [(1000, None), (1001, "")]
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in secrets.secret_spans(frame(spark, rows)).collect()}
    expected = {i: brute_secrets(t) for i, t in rows}
    assert got == expected
    assert {k for spans in got.values() for _, k, _ in spans} == {0, 1, 2, 3}


# 4 near duplicates

def brute_classes(rows, threshold=0.8):
    sets = {i: Counter(tuple(w[k:k + min(5, len(w))]) for k in range(max(1, len(w) - 4))) if (w := re.findall(WORD, t or "")) else None
            for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = sum((sets[a] & sets[b]).values())
            if shared >= threshold * sum((sets[a] | sets[b]).values()):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_near_duplicates(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(30, 200))]
        for _ in range(rnd.choice([1, 1, 2, 5, 20])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "one"), (i + 3, "one"), (i + 4, "one two")]
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_star_of_near_copies(spark):
    """Copies that are each like their base but not like each other are one class with it."""
    rnd = random.Random(6)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(60):
        copy = list(base)
        for k in range(8):
            copy[(i * 53 + k * 47) % 400] = f"x{i}_{k}"
        rows.append((i + 1, " ".join(copy)))
    rows.append((0, " ".join(base)))
    expected = brute_classes(rows)
    assert set(expected.values()) == {0}
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert got == expected


def test_dart_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(7)
    for n, same in ((8, 6), (50, 45), (400, 340), (5000, 4000)):
        agreed, true = [], []
        for _ in range(60):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            b = np.concatenate([a[:same], rng.integers(0, 2**64, n - same, dtype=np.uint64)])
            a[:3], b[:2] = a[0], a[0]
            a, b = np.sort(a), np.sort(b)
            agreed.append((dart_minhash.signature(a, 130) == dart_minhash.signature(b, 130)).mean())
            true.append(dart_minhash.similarity(a, b))
        assert abs(np.mean(agreed) - np.mean(true)) < 0.025


def test_links_beside_a_hot_core(spark):
    """Pairs at similarity 0.8 that share a hot core which is alike to neither (too short, or just below)."""
    rows, partner = [], {}
    for family in range(10):
        core = [f"c{family}_{i}" for i in range(104)]
        rows += [(len(rows) + i, " ".join([*core[:103 - i], *[f"e{family}_{i}_{j}" for j in range(i + 1)]][:104])) for i in range(0, 3)]
        for copy in range(27):
            rows.append((len(rows), " ".join([*core[:-1], f"end{family}_{copy}"])))
        for pair in range(24):
            shared = [f"s{family}_{pair}_{i}" for i in range(12)]
            for side in "ab":
                rows.append((len(rows), " ".join([*core, *shared, *[f"{side}{family}_{pair}_{i}" for i in range(14)]])))
            partner[len(rows) - 1] = len(rows) - 2
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert len(partner) == 240 and [k for k, other in partner.items() if got[k] != got[other]] == []
    assert len({got[k] for k in partner}) == 240  # no two pairs in one class


def test_settled_centres_are_not_looked_at_again(spark, monkeypatch):
    """A later round holds the groups around the centres of its new pairs only; no link is lost by that."""
    rows, partner, held = [], {}, []
    for family in range(2):
        core = [f"c{family}_{i}" for i in range(104)]
        rows += [(len(rows) + i, " ".join([*core[:-1], f"end{family}_{i}"])) for i in range(20)]
        for pair in range(12):
            shared = [f"s{family}_{pair}_{i}" for i in range(12)]
            for side in "ab":
                rows.append((len(rows), " ".join([*core, *shared, *[f"{side}{family}_{pair}_{i}" for i in range(14)]])))
            partner[len(rows) - 1] = len(rows) - 2
    staged = dart_minhash.staged

    def counted(df, name):
        out = staged(df, name)
        if name == "foreign-tokens":
            held.append(out.count())
        return out

    monkeypatch.setattr(dart_minhash, "staged", counted)
    monkeypatch.setattr(dart_minhash, "FEW", 0)  # every group goes through rounds of centres
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert [k for k, other in partner.items() if got[k] != got[other]] == []
    assert len({got[k] for k in partner}) == 24
    assert held[0] > 0 and sum(held[1:]) <= held[0] // 2


def test_links_inside_a_longer_centre(spark):
    """Truncations of one text: each is alike to the next, none to the whole text, and all they share lies in it."""
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate([900, 899, 898, 897, 500, 450, 400, 150, 140, 130, 120])]
    rows += [(100 + i, " ".join([*words[:896], f"x{i}"])) for i in range(20)]
    sets = {i: Counter(tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)) for i, t in rows}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sum((sets[a] & sets[b]).values()) / sum((sets[a] | sets[b]).values()) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert got == root and len(set(root.values())) == 3


def test_texts_are_signed_together(monkeypatch):
    """Texts of any lengths have the same signatures together as one by one; the steps are those of one text."""
    rng = np.random.default_rng(3)
    texts = [np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 2, 7, 130, 517, 20000)]
    texts.append(np.sort(np.repeat(texts[3], 3)))
    together = dart_minhash.signatures(texts, 130)
    assert all((one == dart_minhash.signature(t, 130)).all() for one, t in zip(together, texts))
    mixed, calls = dart_minhash._mixed, []
    monkeypatch.setattr(dart_minhash, "_mixed", lambda x: calls.append(len(x)) or mixed(x))
    dart_minhash.signatures([texts[3]] * 200, 130)
    assert len(calls) <= 200 + 5 * 8


def test_hashed_words(monkeypatch):
    """A word has one hash wherever it stands, also where the text is read in pieces; other words have others."""
    text = "a b  ab\tba \x1c é\x0bé " + "w" * 64 + " " + "w" * 65 + "\n" + "w" * 300 + " a b\r" + " " * 200 + "end " + "w" * 65
    words = text.encode().split()
    for piece in (1 << 16, 70, 64, 5):
        monkeypatch.setattr(dart_minhash, "_PIECE", piece)
        monkeypatch.setattr(dart_minhash, "_LONG", min(64, piece - 1))
        found = dart_minhash._hashed_words(text)
        assert len(found) == len(words)
        assert len(set(zip(words, found.tolist()))) == len(set(words)) == len(set(found.tolist()))
    assert not len(dart_minhash._hashed_words("")) and not len(dart_minhash._hashed_words(" \n"))


def test_few_rows_of_large_groups_need_no_rounds(spark, monkeypatch):
    """Groups with many strangers, but few pairs beside the members, are compared at once, each pair listed once."""
    rows, partner, listed, rounds = [], {}, [], []
    core = [f"c{i}" for i in range(104)]
    rows += [(i, " ".join([*core[:-1], f"end{i}"])) for i in range(20)]
    for pair in range(12):
        shared = [f"s{pair}_{i}" for i in range(12)]
        for side in "ab":
            rows.append((len(rows), " ".join([*core, *shared, *[f"{side}{pair}_{i}" for i in range(14)]])))
        partner[len(rows) - 1] = len(rows) - 2
    # ten unlike texts of one foreign passage around the same core, in one group of more than FEW strangers
    passage = [f"p{i}" for i in range(30)]
    for i in range(10):
        rows.append((len(rows), " ".join([*core, *passage, *[f"q{i}_{j}" for j in range(30)]])))
    rows += [(len(rows) + i, " ".join(f"z{i // 2}_{j}" for j in range(60 + i % 2))) for i in range(2000)]
    staged = dart_minhash.staged

    def counted(df, name):
        out = staged(df, name)
        if name == "pairs":
            rounds.append(out.count())
        if name == "few":
            listed.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(dart_minhash, "staged", counted)
    monkeypatch.setattr(dart_minhash, "FEW", 4)
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame(spark, rows)).collect()}
    assert [k for k, other in partner.items() if got[k] != got[other]] == []
    assert rounds[0] > 0 and sum(rounds[1:]) == 0 and listed[0][0] == listed[0][1] > 0


def test_groups_around_a_centre():
    tokens = dart_minhash.tokens
    a = tokens(np.sort(np.array([1] * 8 + [2, 3, 4, 5, 6], np.uint64)))
    assert len(a) == 13  # occurrences are tokens
    centre = tokens(np.array([7, 8, 9], np.uint64))
    linked, foreign, prefix = dart_minhash.around_centre(a, centre, 0.8)
    assert (linked, len(foreign), prefix) == (False, 13, 3)  # a partner hits 11 of the 13, so one of any three
    linked, foreign, prefix = dart_minhash.around_centre(tokens(np.array([7, 8], np.uint64)), centre, 0.8)
    assert (linked, foreign.tolist(), prefix) == (False, [dart_minhash.INSIDE], 0)
    linked, foreign, _ = dart_minhash.around_centre(tokens(np.array([7, 10], np.uint64)), centre, 0.8)
    assert not linked and len(foreign) == 1 and dart_minhash.INSIDE not in foreign
    linked, foreign, prefix = dart_minhash.around_centre(tokens(np.arange(4, dtype=np.uint64)), tokens(np.arange(5, dtype=np.uint64)), 0.8)
    assert (linked, foreign.tolist(), prefix) == (True, [dart_minhash.INSIDE], 0)


# 5 decontamination

def test_reparameterised_items_are_found(spark):
    items = spark.createDataFrame(
        [(1, "When Alice walks 12 miles in 3 hours and then rests how many miles did Alice walk for each of the 3 hours")],
        "item_id long, text string")
    same = "When Alice walks 12 miles in 3 hours and then rests how many miles did Alice walk for each of the 3 hours"
    new = same.replace("Alice", "Robert").replace("12", "20").replace("3", "4").replace("miles", "feet")
    mixed = "When Alice walks 12 miles in 3 hours and then rests how many feet did Bob walk for each of the 9 hours"
    rows = [(1, "intro words here " + same + " and more"), (2, "He said: " + new + "."), (3, mixed),
            (4, "When Alice walks home she then rests for many hours")]
    got = {r.doc_id: (r.item_id, r.reparameterised) for r in decontaminate.find_leaks(frame(spark, rows), items).collect()}
    assert got == {1: (1, False), 2: (1, True)}  # the slots of document 3 contradict each other


def test_leaks_by_shuffle_equal_leaks_by_lookup(spark):
    rnd = random.Random(8)
    passages = [(i, " ".join(rnd.choice(["the", "a", "Bob", "12", "km", "red", "blue", "sees", "tall", "old"]) + rnd.choice(["", "er", "en"])
                             for _ in range(rnd.randrange(4, 40)))) for i in range(15)]
    rows = [(i, " ".join([rnd.choice(["foo", "bar"])] * 3 + [rnd.choice(passages)[1]] + ["end"])) for i in range(60)]
    items = spark.createDataFrame(passages, "item_id long, text string")
    found = [sorted(map(tuple, decontaminate.find_leaks(frame(spark, rows), items, max_literals=n).collect())) for n in (50_000, 0)]
    assert found[0] == found[1] and found[0]
    long_ones = {i for i, t in passages if len(t.split()) >= 20}
    holds = {(d, i) for d, t in rows for i in long_ones if dict(passages)[i] in t}
    assert holds <= {(r[0], r[2]) for r in found[0]}


# 6 licenses

def test_longest_increasing_and_alignment():
    rnd = random.Random(9)
    for _ in range(200):
        v = [rnd.randrange(12) for _ in range(rnd.randrange(0, 10))]
        best = 0
        for mask in range(1 << len(v)):
            s = [x for i, x in enumerate(v) if mask >> i & 1]
            if all(a < b for a, b in zip(s, s[1:])):
                best = max(best, len(s))
        got = license_scan.longest_increasing(v)
        assert len(got) == best and all(v[a] < v[b] for a, b in zip(got, got[1:]))
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randrange(10))] for _ in range(2))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def common_words(a, b):
    """Length of a longest common subsequence, by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_planted_licenses_against_the_whole_table(spark):
    rnd = random.Random(31)
    filler = [f"w{i}" for i in range(300)] + ["the", "of", "software", "public", "license", "permission", "version"]
    rows, planted = [], {}
    for i, (name, template) in enumerate(license_scan.TEMPLATES.items()):
        for j in range(4):
            words = template.split()
            if len(words) >= 15 and j:  # a word more, a word less
                words.insert(rnd.randrange(1, len(words) - 1), "extra")
                del words[rnd.randrange(2, len(words) - 2)]
            before, after = ([rnd.choice(filler[:300] if j < 2 else filler) for _ in range(rnd.randrange(3, 60))] for _ in "ab")
            rows.append((4 * i + j, " ".join([*before, "head", *words, "tail", *after])))
            planted[4 * i + j] = (name, len(" ".join([*before, "head"])) + 1, " ".join(words))
    got = {r.doc_id: r.licenses for r in license_scan.license_scan(frame(spark, rows)).collect()}
    for i, text in rows:
        name, start, passage = planted[i]
        template = license_scan.words_with_offsets(license_scan.TEMPLATES[name])[0]
        assert any(m.start < start + len(passage) and m.end > start and (m.license == name or m.coverage >= 0.85)
                   for m in got[i]), (name, got[i])
        if passage == license_scan.TEMPLATES[name]:
            same = {n for n, t in license_scan.TEMPLATES.items() if license_scan.words_with_offsets(t)[0] == template}
            assert any(m.license in same and m.coverage == 1.0 for m in got[i]), (name, got[i])
        for m in got[i]:
            whole = license_scan.words_with_offsets(license_scan.TEMPLATES[m.license])[0]
            part = license_scan.words_with_offsets(text[m.start:m.end])[0]
            assert common_words(part, whole) >= round(m.coverage * len(whole)) >= 0.85 * len(whole) - 1e-9
            assert round(m.coverage * len(whole)) >= 0.7 * len(part)


def test_tags_and_short_forms():
    ready = [license_scan.Template(n, t) for n, t in license_scan.TEMPLATES.items()]

    def names(text):
        return [m[0] for m in license_scan.scan_text(text, ready)]

    assert names("// SPDX-License-Identifier: LGPL-3.0-or-later\nint x;") == ["LGPL-3.0-or-later-tag"]
    assert names("# SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: Zlib") == ["MIT-tag", "Zlib-tag"]
    assert names("The MIT License (MIT) Copyright") == ["MIT-title"]
    assert names("It is Licensed under the MIT License.") == ["MIT-licensed"]
    assert names("under the GNU Affero General Public License, version 3, as") == ["AGPL-3.0-name"]
    assert names("GNU General Public License, version 2") == ["GPL-2.0-name"]
    assert names("a license to drive, the public domain of the city, and MIT in Boston") == []


def test_licenses_in_text(spark):
    notice = license_scan.TEMPLATES["GPL-3.0-notice"]
    edited = notice.replace("redistribute it", "share and redistribute it").replace("modify", "change")
    rows = [(1, f"é words\n{notice}\nmore words Released under the MIT License."), (2, edited), (3, "a license to the public"),
            (4, "Licensed under CC BY 4.0."), (5, None)]
    got = {r.doc_id: r.licenses for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert [m.license for m in got[1]] == ["GPL-3.0-notice", "MIT"]
    assert rows[0][1][got[1][0].start:got[1][0].end] == notice and got[1][0].coverage == 1.0
    assert [m.license for m in got[2]] == ["GPL-3.0-notice"] and got[2][0].coverage < 1
    assert got[3] == [] and got[5] == [] and [m.license for m in got[4]] == ["CC-BY-4.0"]


# 7 personal data

def brute_pii(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_pii_base_spans():
    rnd = random.Random(10)
    parts = ["1", "2", "25", "300", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "@x.y", "4539578763621486", "é", " 555-"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 22)))
        assert sorted(pii.base_spans(text)[0]) == brute_pii(text)


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(11)
    n, right = 40_000, [0.95, 0.9, 0.8, 0.75, 0.7, 0.85]
    truth = rng.random(n) < 0.4
    votes = np.stack([np.where(rng.random(n) < 0.3, 0, np.where((rng.random(n) < r) == truth, 1, -1)) for r in right], axis=1)
    patterns = ((votes + 1) * 3 ** np.arange(6)).sum(axis=1)
    posterior, table, prior = pii.em(Counter(patterns.tolist()))
    assert abs(prior - 0.4) < 0.02
    for k, r in enumerate(right):
        assert abs(table[1, k, 2] / (table[1, k, 2] + table[1, k, 0]) - r) < 0.03
    guess = np.array([posterior[p] for p in patterns]) > 0.5
    assert (guess == truth).mean() > 0.93


def test_pii_adds_spans_and_keeps_base(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(200):
        digits = "".join(rnd.choice("0123456789") for _ in range(9))
        rows.append((i, rnd.choice([
            f"please call +1 (017) 555-7{digits[:3]} today", f"mail {digits}@mail.example.com now", "nothing at all here",
            f"contact account {digits[:3]} {digits[3:6]} {digits[6:]} or mail ab{digits}@x.org", f"version {digits}",
            f"Dr. Maria Lopez lives at 10.0.0.{i} é"])))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.pii_spans(frame(spark, rows)).collect()}
    for i, text in rows:
        assert [s for s in got[i] if s[0] < 4] == brute_pii(text)
        assert all(text[a:b] for _, a, b in got[i])
    added = {text.split()[0] for i, text in rows for s in got[i] if s[0] >= 4}
    assert "contact" in added and "version" not in added


def pii_texts(seed, n):
    """``(doc_id, text)`` and the personal data of each text beside the base kinds; the rest are decoys."""
    rnd = random.Random(seed)
    number = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def iban(right):
        body = rnd.choice(["DE", "FR", "ES"]) + "00" + number(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        body = f"{body[:2]}{(check if right else check % 97 + 1):02d}{body[4:]}"
        return " ".join(body[i:i + 4] for i in range(0, len(body), 4))

    rows, truth = [], []
    for i in range(n):
        person = f"{rnd.choice(['Anna', 'Klaus', 'Pierre', 'Carmen', 'Emily', 'Jürgen'])} {rnd.choice(['Weber', 'Moreau', 'Gomez', 'Hill'])}"
        titled = f"{rnd.choice(['Dr.', 'Frau', 'Madame', 'Señor'])} {rnd.choice(['Weber', 'Moreau', 'Gomez', 'Hill'])}"
        ssn = f"{number(3)}-{number(2)}-{number(4)}"
        good = iban(True)
        text, real = rnd.choice([
            (f"contact: {person} , account {ssn} thanks", [person, ssn]),
            (f"dear {titled} , mail anna@mail.example.com today", [titled]),
            (f"Konto {good} for {person} .", [good, person]),
            (f"bestellung number iban-like {iban(False)} was printed on page 3", []),
            (f"invoice {number(9)} of version {number(8)}", []), (f"order {number(14)} shipped", []),
            ("nothing personal in this line", []), (f"it is {number(10)} in all", [])])
        rows.append((i, text))
        truth.append({(text.index(x), text.index(x) + len(x)) for x in real})
    return rows, truth


def test_pii_added_spans_on_held_out_labels(spark):
    """A model fitted without labels on one corpus, judged by the labels of another."""
    train, _ = pii_texts(21, 600)
    rows, truth = pii_texts(22, 400)
    counts = Counter((cell, pattern) for _, t in train for *_, pattern, cell in pii.candidates(t)[1])
    by_pattern = Counter()
    for (_, pattern), n in counts.items():
        by_pattern[pattern] += n
    posterior, _, _ = pii.em(by_pattern)
    cells = sorted({c for c, _ in counts})
    n = np.array([sum(k for (c, _), k in counts.items() if c == cell) for cell in cells], float)
    soft = np.array([sum(k * posterior[p] for (c, p), k in counts.items() if c == cell) for cell in cells]) / n
    accepted = [c for c, z in zip(cells, pii._design(cells) @ pii.train(cells, n, soft)) if z > 0]
    got = {r.doc_id: {(s.start, s.end) for s in r.spans if s.kind >= 4} for r in pii.pii_spans(
        frame(spark, rows), model={"accepted": accepted}).collect()}
    plain = {i: {(a, b) for k, a, b, _, cell in pii.candidates(t)[1] if k >= 4 and cell in accepted} for i, t in rows}
    assert got == plain
    fitted = pii.fit(frame(spark, train).select(F.col("doc_id").alias("id"), "text").mapInArrow(
        pii._extract(pii.FIRST_NAMES), "id long, base array<struct<kind:int,start:int,end:int>>,"
        " candidates array<struct<kind:int,start:int,end:int,pattern:int,cell:int>>"))
    assert fitted["accepted"] == accepted  # the same model from counts on Spark
    hits = sum(len(got[i] & t) for (i, _), t in zip(rows, truth))
    precision, recall = hits / sum(map(len, got.values())), hits / sum(map(len, truth))
    print("precision, recall", precision, recall)
    assert precision >= 0.95 and recall >= 0.9


def test_pii_names_and_ibans():
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE88 3704 0044 0532 0130 00")
    spans = lambda t, **k: [(pii.KINDS[s[0]], t[s[1]:s[2]]) for s in pii.candidates(t, **k)[1]]
    assert spans("IBAN GB82 WEST 1234 5698 7654 32 here") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert spans("by Céline Moreau and by Björk Berg") == [("person", "Céline Moreau")]
    assert spans("by Björk Berg", known=frozenset(["Björk"])) == [("person", "Björk Berg")]


# 8 token counts

def test_token_counts(spark):
    import public_tokenizers
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    rnd = random.Random(13)
    parts = ["the", "Hello", " ", "  ", "\n", "\n\n", "\t", "é", "日本語", "▁", "😀", "<s>", "</s>", "<0x0A>", "1234", ".", "word ", " ", "\x00", "   x"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 25)))) for i in range(500)]
    rows += [(900, None), (901, ""), (902, " "), (903, "\n"), (904, " \n "), (905, "a" * 5000), (906, "tok " * 5000)]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(
        spark.createDataFrame(rows, "doc_id long, text string"), model, table_size=50).collect()}
    for i, text in rows:
        n = len(processor.encode(text or ""))
        assert got[i] == (len((text or "").encode()), n, n > 4096), repr(text)


# 9 mixing

def test_raking_meets_the_targets(spark):
    rnd = random.Random(14)
    rows = [(i, "x" * rnd.randrange(1, 400), rnd.choice("aab"), rnd.choice(["en", "de"]), rnd.choice("pq")) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}, "topic": {"p": 0.6, "q": 0.4}}
    mixed = mixing.mix(df, targets, fraction=0.5)
    pdf = mixed.toPandas()
    pdf["expected"] = pdf.n_tokens * pdf.probability * pdf.weight
    for name, shares in targets.items():
        got = pdf.groupby(name).expected.sum() / pdf.expected.sum()
        assert all(abs(got[v] - s) < 1e-6 for v, s in shares.items())
    assert abs((pdf.n_tokens * pdf.probability).sum() / pdf.n_tokens.sum() - 0.5) < 1e-9
    pdf["sampled"] = pdf.n_tokens * pdf.weight * pdf.kept
    for name, shares in targets.items():
        got = pdf.groupby(name).sampled.sum() / pdf.sampled.sum()
        assert all(abs(got[v] - s) < 0.04 for v, s in shares.items())
    by_joins = {r.doc_id: r.probability for r in mixing.mix(df, targets, fraction=0.5, max_cells=0).collect()}
    assert all(abs(p - by_joins[i]) < 1e-6 for i, p in zip(pdf.doc_id, pdf.probability))


def _random_cells(seed):
    rnd = random.Random(seed)
    return [(i, rnd.choice("abcd"), rnd.choice(["en", "de", None]), rnd.choice("pqr"), rnd.randrange(1, 900)) for i in range(400)]


@pytest.mark.parametrize("targets", [{}, {"source": {"a": 3, "b": 1, "c": 1, "d": 1}, "topic": {"p": 0.2, "q": 0.8}}])
def test_raking_is_alike_at_every_size(spark, monkeypatch, targets):
    monkeypatch.setattr(mixing, "ROUNDS", 4)  # also where the rounds end first
    rows = spark.createDataFrame(_random_cells(5), "doc_id long, source string, lang string, topic string, n long").withColumn("text", F.lit("x"))
    small, large = ({r.doc_id: r for r in mixing.mix(rows, targets, max_cells=m, tokens_col="n").collect()} for m in (1000, 0))
    assert len(small) == len(large) == 400
    for i, r in small.items():
        assert r.n_tokens == r.n and abs(r.probability - large[i].probability) < 1e-9 and abs(r.weight - large[i].weight) < 1e-9


@pytest.mark.parametrize("max_cells", [1000, 0])
def test_targets_that_cannot_be_met(spark, monkeypatch, max_cells):
    rows = spark.createDataFrame([(1, "x" * 40, "a", "en", "p"), (2, "x" * 40, "b", "de", "p")],
                                 "doc_id long, text string, source string, lang string, topic string")
    monkeypatch.setattr(mixing, "ROUNDS", 2)
    with pytest.raises(ValueError, match="positive target"):
        mixing.mix(rows, {"source": {"c": 1.0}}, max_cells=max_cells)
    with pytest.raises(ValueError, match="exclude each other"):
        mixing.mix(rows, {"source": {"a": 1.0}, "lang": {"de": 1.0}}, max_cells=max_cells)
    with pytest.warns(mixing.UnmetTargets):
        mixing.mix(rows, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.9, "de": 0.1}}, max_cells=max_cells)


# 10 substring dedup

def brute_windows(texts, window):
    words = [re.findall(WORD, t or "") for t in texts]
    counts = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + o for i in range(len(w) - window + 1) if counts[tuple(w[i:i + window])] > 1 for o in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 2}, {"hot": 3, "shard_words": 300}])
def test_substring_dedup(spark, options):
    rnd = random.Random(15)

    def text(n, v):
        return " ".join(rnd.choice("abcdefghijklmnop"[:v]) for _ in range(n))

    rows = [(i, text(rnd.randrange(0, 60), rnd.choice([1, 2, 3, 16]))) for i in range(100)]
    shared = [text(14, 16) for _ in range(4)]
    rows += [(200 + i, f"{text(rnd.randrange(20), 16)} {rnd.choice(shared)[rnd.randrange(3):]} {text(rnd.randrange(20), 16)}")
             for i in range(120)]
    rows += [(None, None), (None, rows[3][1]), (7, ""), (8, "  \n "), rows[5], rows[5]]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(
        frame(spark, rows), window=10, gram=3, **options).collect())
    assert got == sorted((str(i), *b) for (i, _), b in zip(rows, brute_windows([t for _, t in rows], 10)))


def places(sequences, copies):
    """How often each stretch of words occurs in the sequences, those marked counted twice."""
    return Counter(tuple(s[i:j].tolist()) for s, c in zip(sequences, copies) for _ in range(1 + c)
                   for i in range(len(s)) for j in range(i + 1, len(s) + 1))


@pytest.mark.parametrize("share", [0.0, 0.3])
def test_fm_index_matching_statistics(share):
    rng = np.random.default_rng(16)
    for sigma in (2, 5, 300):
        sequences = [rng.integers(1, sigma + 1, rng.integers(1, 40)).astype(np.uint64) for _ in range(30)]
        sequences += [sequences[3][:20], np.concatenate([sequences[4], sequences[5]])]
        copied = rng.random(len(sequences)) < share
        counts = places(sequences, copied)
        documents = sequences + [rng.integers(1, sigma + 4, 50).astype(np.uint64) for _ in range(8)]  # also unknown words
        documents.append(np.zeros(0, np.uint64))
        index = FMIndex(sequences, 100, copied)
        for d in documents:
            longest = [max([n for n in range(1, e + 2) if counts[tuple(d[e + 1 - n:e + 1].tolist())] > 1], default=0)
                       for e in range(len(d))]
            assert index.matching_statistics(d).tolist() == longest
        expected = {(q, i) for q, d in enumerate(documents) for i in range(len(d) - 5) if counts[tuple(d[i:i + 6].tolist())] > 1}
        runs = index.repeated_windows(documents, 6)
        assert {(q, i) for q, a, b in runs for i in range(a, b)} == expected
        assert len(runs) == len({(q, a) for q, a, _ in runs}) and all(
            (q, b) not in expected and (q, a - 1) not in expected for q, a, b in runs)  # whole runs


def test_fm_index_bits():
    rng = np.random.default_rng(17)
    for n in (0, 1, 63, 64, 65, 4095, 4096, 70_000):
        for share in (0, 0.001, 0.5, 1):
            bits = (rng.random(n) < share).astype(np.uint8)
            assert _Bits(bits).rank(np.arange(n + 1)).tolist() == np.concatenate([[0], np.cumsum(bits)]).tolist()
    runs = np.repeat(rng.integers(0, 2, 700), 1000).astype(np.uint8)
    assert _Bits(runs).nbytes * 8 < 0.2 * len(runs)  # long runs take a fraction of their bits


def test_fm_index_takes_the_entropy():
    """Frequent words lie on few levels: the levels hold about the entropy of the words, not the bits of the alphabet."""
    rng = np.random.default_rng(19)
    words = np.minimum(rng.geometric(0.4, 50_000), 40).astype(np.uint64)
    words[:3000] = np.arange(3000) + 100  # rare words
    index = FMIndex([words], 60)
    counts = np.unique(words, return_counts=True)[1]
    entropy = -(counts / len(words) * np.log2(counts / len(words))).sum()
    taken = index.codes, index.lengths
    assert (index.lengths[1:] * counts).sum() / len(words) < 1.15 * entropy < 0.5 * np.log2(len(counts))
    assert 8 * index.nbytes < 1.8 * 1.15 * entropy * len(words)  # counts and half-empty blocks included
    starts = sorted((int(c), int(c) + (1 << (32 - int(n)))) for c, n in zip(*taken))
    assert all(end <= start for (_, end), (start, _) in zip(starts, starts[1:]))  # no code begins another
    pair = Counter(zip(words.tolist(), words[1:].tolist()))
    found = index.matching_statistics(words[-500:])
    assert all((n > 1) == (pair[tuple(words[i - 1:i + 1].tolist())] > 1) for i, n in zip(range(len(words) - 500, len(words)), found) if i > len(words) - 500)


def test_fm_index_of_repetitive_text():
    """Long runs of equal bits in the transform: hundreds of near copies, intervals searched at both ends at once."""
    rng = np.random.default_rng(20)
    passage = rng.integers(1, 30, 60).astype(np.uint64)
    sequences = []
    for i in range(1500):
        s = passage.copy()
        s[rng.integers(0, 60, 2)] = 1000 + rng.integers(0, 900, 2)
        sequences.append(s[rng.integers(0, 5):])
    index = FMIndex(sequences, 70)
    assert not all(b.dense for b in index.levels)
    counts = Counter(s[i:i + 12].tobytes() for s in sequences for i in range(len(s) - 11))
    expected = {(q, i) for q, s in enumerate(sequences) for i in range(len(s) - 11) if counts[s[i:i + 12].tobytes()] > 1}
    assert {(q, i) for q, a, b in index.repeated_windows(sequences, 12) for i in range(a, b)} == expected
    bits = _Bits(np.repeat(np.array([0, 1, 0, 1, 1], np.uint8), 300))
    at = np.arange(1500).reshape(-1, 2)
    assert not bits.dense and bits.rank(at).ravel().tolist() == bits.rank(at.ravel()).tolist()


def test_substring_dedup_through_the_index(spark):
    """Copies and partial repeats are found by the index; only anchors above ``hot`` are counted."""
    words = [f"w{i}" for i in range(400)]
    rnd = random.Random(18)
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(40)) + (f" {passage} tail{i}" if i < 20 else "")) for i in range(40)]
    rows += [(100 + i, rows[30][1]) for i in range(30)]
    docs = frame(spark, rows)
    kinds = {hot: {r.kind for r in substring_dedup.repeated_segments(docs, hot=hot)[2].select("kind").distinct().collect()}
             for hot in (5, 1000)}
    assert kinds[1000] == {"index"} and "hot" in kinds[5]
    expected = sorted((i, *b) for (i, _), b in zip(rows, brute_windows([t for _, t in rows], 35)))
    for hot in (5, 1000):
        got = substring_dedup.substring_dedup(docs, hot=hot).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected
