import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline as pipeline
from sluice.llm import jaccard, language
from sluice.llm.queries import QUERIES, SQL


def plain_exact(rows):
    keep = {}
    for doc_id, text in rows:
        norm = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        keep[norm] = max(keep.get(norm, doc_id), doc_id)
    return [r for r in rows if r[0] in set(keep.values())]


def plain_near(rows):
    sets = {i: jaccard.shingles(t, 5) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if len(sets[a]) and len(sets[b]) and jaccard.linked(sets[a], sets[b], 80):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return [(i, t) for i, t in rows if find(i) == i]


def plain_cut(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        at, kept = 0, ""
        for c in text or "":
            n = len(c.encode())
            kept += "" if gone[at : at + n].all() else c
            at += n
        if kept or not text:
            out.append((doc_id, kept))
    return out


def corpus():
    draw = random.Random(9)
    words = {
        "en": ["the", "this", "with", "think", "other", "whether", "weather", "nothing", "breath", "should"],
        "de": ["und", "nicht", "schön", "über", "zwischen", "größe", "straße", "können", "für", "möchte"],
        "fr": ["être", "où", "français", "garçon", "élève", "voilà", "même", "très", "forêt", "déjà"],
    }
    passage = " ".join(draw.choices(words["en"], k=30))
    rows = []
    for i in range(150):
        lang = draw.choice(list(words))
        own = [w + draw.choice(["", "s", "er", "en"]) for w in draw.choices(words[lang], k=draw.choice([20, 60, 150]))]
        if i % 5 == 0:
            own = passage.split() + own
        rows.append((i, " ".join(own), lang))
    for i in range(150, 200):
        base = list(rows[draw.randrange(60)])
        kind = i % 3
        if kind == 0:
            base[1] = base[1].upper()
        elif kind == 1:
            base[1] = base[1] + " extra"
        rows.append((i, base[1], base[2]))
    return rows + [(200, None, "en"), (201, "12 34 .. !!", "de"), (202, "", None)]


def test_run_against_a_plain_version(spark, tmp_path):
    rows = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], schema)
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    left = {r.doc_id for r in pipeline.known_language(spark, docs, str(tmp_path)).collect()}
    assert left == {i for i, t, _ in rows if t and any(map(str.isalpha, t))}
    want = plain_cut(plain_near(plain_exact([(i, t) for i, t, _ in rows if i in left])))
    assert len(want) < 180

    from tests.llm.test_packing import check

    check(pipeline.run(spark, str(tmp_path)).collect(), want)


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(docs, spark, name, stage):
    source = docs([(1, "some text that is long enough to be kept here"), (None, None), (1, ""), (2, "x"), (2, "x"), (3, "Some other text")])
    got = stage(spark, source, "")
    assert got.columns == source.columns
    assert dict(got.dtypes) == dict(source.dtypes)
    assert got.where("doc_id = 3").count() == 1
    assert stage(spark, docs([]), "").collect() == []


CLASHES = ["_own_sha", "_kept_id", "_kept_sha", "_language", "_score", "_judged", "_own", "_id", "_sha", "_kept", "_dropped", "node", "kept", "component_id"]


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_columns_with_helper_names_keep_their_values(docs, spark, name, stage):
    from pyspark.sql import functions as F

    source = docs([(1, "some text that is long enough to be kept here"), (2, "Other words"), (2, "Other words"), (3, "some text that is long enough to be kept here!")])
    source = source.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    got = stage(spark, source, "")
    assert got.columns == source.columns and got.count() >= 2
    for row in got.collect():
        assert [row[c] for c in CLASHES] == [f"{c}{row.doc_id}" for c in CLASHES]


def test_stages_may_be_put_together_without_writing(docs, spark):
    source = docs([(i, f"text number {i} of a few that differ in a word or so") for i in range(20)] + [(30, "Text number 3 of a few that differ in a word or so")])
    out = source
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, out, "")
    assert {r.doc_id for r in out.collect()} == {*range(20), 30} - {3}


def test_without_any_language_texts_with_letters_stay(spark):
    rows = [(1, "some text", None), (2, None, None), (3, "12 ..", None), (None, "é", None), (4, "", None), (1, "some text", None)]
    source = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = pipeline.known_language(spark, source, "")
    assert got.columns == source.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "é"), (1, "some text"), (1, "some text")]


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert [n for n, _ in pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    assert language.UNKNOWN == "und" and hashlib
