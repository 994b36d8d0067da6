"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names, for every operator and stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from botpulse.llm import (
    dart_minhash, decontaminate, license_scan, line_dedup, mixing, pii, quality, secrets, substring_dedup, token_counts)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(60_000))
PROSE = "\n".join(" ".join(f"word{i}{j}" for j in range(12)) for i in range(6))
ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, None, None, None),
    (None, PROSE, "xx", "a", 1),
    (3, None, "en", "b", 0),
    (4, "", "en", "b", 0),
    (None, None, None, None, None),
    (5, " \n\t\r ", "fr", "b", 5),
    (6, LONG, "de", "c", len(LONG)),
    (7, "x" * 200_000, "es", "c", 200_000),
    (8, "Straße 😀 licensed under the MIT License", "de", "c", 40),
]
# Names that operators use themselves, as extra columns.
EXTRA = ["id", "key", "r1", "r2", "kept", "n_words", "n_tokens", "weight", "topic", "class_id", "kept_text", "secrets",
         "words", "first", "bucket", "quality_features", "base_failed", "root", "n_removed", "probability"]


@pytest.fixture(scope="module")
def model_file():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in EXTRA}).coalesce(2).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta"), (2, None), (None, "")], "item_id long, text string")


def operators(items, model_file):
    return {
        "quality": quality.quality_rules,
        "line_dedup": line_dedup.line_dedup,
        "secrets": secrets.secret_spans,
        "dart_minhash": dart_minhash.near_duplicate_classes,
        "license_scan": license_scan.license_scan,
        "pii": pii.pii_spans,
        "token_counts": lambda d: token_counts.token_counts(d, model_file),
        "mixing": mixing.mix,
        "substring_dedup": substring_dedup.substring_dedup,
    }


NAMES = ["quality", "line_dedup", "secrets", "dart_minhash", "license_scan", "pii", "token_counts", "mixing", "substring_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(docs, items, model_file, name):
    found = operators(items, model_file)[name](docs).collect()
    assert len(found) == len(ROWS)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, items, model_file, name):
    assert operators(items, model_file)[name](spark.createDataFrame([], SCHEMA)).collect() == []


def test_quality_values(docs):
    rows = quality.quality_rules(docs).collect()
    empty = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in empty)
    assert all(r.kept == (not r.base_failed) for r in rows if r.n_words < 80)


def test_line_dedup_keeps_repeated_rows_and_cuts_later_copies(docs):
    rows = line_dedup.line_dedup(docs).collect()
    # the null id comes first, so its copy stays; both rows of document 1 are one document behind it
    removed = {(r.doc_id, r.n_removed) for r in rows if r.text == PROSE}
    assert removed == {(None, 0), (1, 6), (2, 6)}
    assert all(r.kept_text == (r.text or "") for r in rows if r.text != PROSE)


def test_near_duplicates_values(docs):
    rows = dart_minhash.near_duplicate_classes(docs).collect()
    same = [r for r in rows if r.text == PROSE]
    assert {r.class_id for r in same} == {1} and [r.doc_id for r in same if r.class_keeps] == [1, 1]
    assert all(r.class_keeps and r.class_id == r.doc_id for r in rows if not (r.text or "").strip())
    kept = dart_minhash.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, None, 5, 6, 7, 8]))


def test_substring_values(docs):
    rows = substring_dedup.substring_dedup(docs).collect()
    assert all(r.n_removed == r.n_words == 72 and r.kept_text == "" for r in rows if r.n_words == 72)
    assert {r.n_words for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert [r.n_removed for r in rows if r.doc_id == 6] == [0]


def test_mixing_values(docs):
    rows = mixing.mix(docs).collect()
    assert all(0 < r.probability <= 1 and r.weight >= 1 - 1e-9 and r.topic == "x" for r in rows)
    assert all(r.n_tokens >= 1 for r in rows)


def test_tokens_values(docs, model_file):
    rows = {r.doc_id: r for r in token_counts.token_counts(docs, model_file).collect() if r.doc_id is not None}
    assert (rows[3].n_bytes, rows[3].n_tokens, rows[4].n_tokens) == (0, 0, 0)
    assert rows[6].over_limit and not rows[8].over_limit


def test_leaks(spark, docs, items):
    assert decontaminate.find_leaks(docs, items).collect() == []
    own = spark.createDataFrame([(9, PROSE)], "item_id long, text string")
    found = decontaminate.find_leaks(docs, own).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "2", "None"]  # repeated rows once
    left = decontaminate.without_leaks(docs, own)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 4
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, empty).collect() == []
    assert decontaminate.without_leaks(docs, empty).count() == len(ROWS)
    assert decontaminate.find_leaks(docs.limit(0), own).collect() == []


def test_leaks_with_clashing_names(spark, docs):
    own = spark.createDataFrame([(9, PROSE)], "item_id long, text string")
    for name, id_name, item_name in (("id", "id", "item_id"), ("key", "doc_key", "item_key"), ("covered", "doc_covered", "item_covered")):
        rows, items = docs.select(docs.doc_id.alias(name), "text"), own.withColumnRenamed("item_id", name)
        found = decontaminate.find_leaks(rows, items, id_col=name, item_col=name)
        assert found.columns[:3] == [id_name, "key", item_name] and len(set(found.columns)) == 8
        assert sorted(str(r[id_name]) for r in found.collect()) == ["1", "2", "None"]
        left = decontaminate.without_leaks(rows, items, id_col=name, item_col=name)
        assert left.columns == rows.columns and left.count() == len(ROWS) - 4


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, docs, items, tmp_path, number):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, docs, str(tmp_path))
    if number < 4:
        assert out.columns == docs.columns
    assert out.count() <= len(ROWS)
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
