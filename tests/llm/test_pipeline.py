"""The stages of the pipeline one by one, on awkward rows and names, and the whole run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import ann, decontam, langid, lines, lm, mixing, secrets, simhash, substrings, urls

NAMES = [
    "size", "taken", "n_blocks", "target", "source_size", "kept", "_gone", "gone", "leaked", "tag", "key", "mark", "found", "others", "none", "n_lines", "n_dropped", "lang_pred", "score", "held_out", "node", "component",
    "fp", "row", "line", "words", "rank", "leaf", "part", "share", "host", "path", "shape", "draw", "shard", "value", "a", "b", "_id", "first", "island", "digest", "item", "seed", "shift", "all", "base", "loose",
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(40)
    vocabulary = {"en": ["the", "of", "house", "river", "walking", "thing", "and", "with"], "fr": ["le", "été", "maison", "rivière", "où", "chose", "avec", "dans"]}
    word = lambda lang: str(rng.choice(vocabulary[lang])) + ("".join(rng.choice(list("abcdefgh"), 4)) if rng.random() < 0.4 else "")
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    item = text("en", 40)
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        rows.append((i, "\n".join(text(lang, int(rng.integers(8, 30))) for _ in range(6)), lang, f"s{i % 3}", 7))
    rows += [(100, rows[1][1], "en", "s1", 7), (101, text("en", 30) + " " + item, "en", "s0", 7), (102, None, None, None, None), (103, "", "en", "s9", 0), (104, "123 456", None, "s1", 7), (105, rows[2][1].split("\n")[0] + "\n" + text("en", 50), "en", None, 7)]
    rows += [rows[5], (None, text("en", 30), "en", "s2", 7), (6, text("en", 20), "en", "s2", 7), (107, " ".join(text("en", 1) for _ in range(9000)), "en", "s1", 7)]
    folder = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_each_stage_and_the_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        rows[name] = docs.collect()
        if name != "mix_sources":
            assert docs.columns == columns
            docs = spark.createDataFrame(rows[name], before.schema)
    ids = {name: [r.doc_id for r in found] for name, found in rows.items()}
    assert not {102, 103, 104} & set(ids["language_id"]) and len(ids["language_id"]) == 67
    cleaned = {r.doc_id: r for r in rows["line_dedup"]}
    assert len(rows["line_dedup"]) == 67 and cleaned[100].text == "\n" * 0 and "\n" not in cleaned[105].text and all(r.n_chars == len(r.text) for r in rows["line_dedup"])
    assert sorted(map(str, ids["simhash_near_dedup"])) == sorted(map(str, [*range(60), 6, None, 100, 101, 105, 107]))
    assert sorted(map(str, ids["decontaminate"])) == sorted(map(str, [*range(60), 6, None, 100, 105, 107]))
    assert 100 not in ids["mix_sources"] and all(0 < r.taken <= 3 * r.size and r.size == len(r.text.split()) for r in rows["mix_sources"])
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (str(r.doc_id), r.text, r.taken, r.source)
    assert sorted(map(key, whole)) == sorted(map(key, rows["mix_sources"]))


def test_stages_take_any_column_names_and_no_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.lit(f"v{c}") for c in NAMES})
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        assert len({c.lower() for c in found.columns}) == len(found.columns)
        for c in docs.columns:  # other columns are there, with their values
            if name != "mix_sources":
                assert c in found.columns
        rows = found.collect()
        assert rows and all(r[c] == f"v{c}" for r in rows for c in NAMES if c in found.columns and not (name == "mix_sources" and c in mixing.OUTPUT))
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_operators_take_any_column_names(spark, sf_dir):
    wide = {c: F.lit("x") for c in NAMES}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns(wide)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumns({c: F.lit("x") for c in NAMES if c not in ("item_id", "text")})
    n = docs.count()
    assert {r.doc_id for r in decontam.overlaps(docs, bench).collect()} == {101}
    assert langid.held_out_predictions(docs).count() == lm.held_out_scores(docs).count() == n
    assert simhash.cluster(docs).count() == secrets.digest(secrets.scan(docs)).count() == mixing.mix(docs).count() == lines.dedup(docs).count() == n
    assert substrings.dedup(docs).columns == docs.columns
    assert langid.identify(docs, None).where("lang_pred = 'und' AND score = 0").count() == n
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(60)], "vec_id long, embedding array<double>").withColumns(wide)
    assert ann.neighbours(vectors).count() == 60
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.net/a/{i}") for i in range(30)], "page_id long, url string").withColumns(wide)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").withColumns(wide)
    assert urls.judge(pages, urls.labels_by_number(pages, labels)).count() == 30
