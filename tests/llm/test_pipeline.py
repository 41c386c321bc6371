"""The corpus pipeline against brute force on small tables, and its odd inputs."""

from __future__ import annotations

import random

import corpus_pipeline
from mentionlab.llm import quality
from tests.llm.test_operators import brute_components, brute_hits, brute_lines, prose


def tables(spark, folder, rows, labels, items):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_hit int, copy string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def corpus():
    r = random.Random(12)
    items = [(i, prose(r, 20)) for i in range(5)]
    texts = []
    for i in range(160):
        t = prose(r, r.randint(10, 90))
        if i % 5 == 0:
            t = " ".join(w + "***" for w in t.split())
        if i % 7 == 0:
            t = "one line that many share\n" + t
        if i % 11 == 0:
            t += " " + items[i % 5][1]
        texts.append(t)
    texts[40] = texts[33]
    texts[41] = texts[36] + " word"
    rows = [(i, t, "en", "s" + str(i % 3), len(t), 1, "c") for i, t in enumerate(texts)]
    return rows, [(i, int(i % 5 != 0), 0) for i in range(160)], items


def test_pipeline_equals_brute_force(spark, workdir):
    rows, labels, items = corpus()
    tables(spark, f"{workdir}/t", rows, labels, items)
    out = corpus_pipeline.run(spark, f"{workdir}/t").collect()

    data = spark.read.parquet(f"{workdir}/t/documents.parquet")
    model = quality.fit_quality(data, spark.read.parquet(f"{workdir}/t/labels.parquet"))
    left = [(x[0], x[1]) for x in rows if model.score([x[1].encode()])[0] >= quality.THRESHOLD]
    assert len(left) < len(rows)
    left = [(i, t) for i, t, _, _ in brute_lines(left)]
    comps = brute_components(left, 5, 80)
    left = [(i, t) for i, t in left if comps[i][1] == i]
    left = [(i, t) for i, t in left if brute_hits(t, items)[1] == 0]
    clean = dict(left)
    assert all(x.text == clean[x.doc_id] and x.n_chars == len(x.text) for x in out)
    # the mix takes every source near its share of what is left
    size, taken = {}, {}
    source = {x[0]: x[3] for x in rows}
    for i, t in left:
        size[source[i]] = size.get(source[i], 0) + len(t.split())
    for x in out:
        taken[x.source] = taken.get(x.source, 0) + len(x.text.split())
    total = sum(size.values())
    weights = {"s0": 5, "s1": 2, "s2": 1}
    for s, w in weights.items():
        assert abs(taken[s] - min(3 * size[s], total * w / 8)) <= 3 * 110


def test_near_stage_keeps_one_of_each_group_without_id(spark, workdir):
    r = random.Random(3)
    a, b, c = (prose(r, 50, ("alpha", "beta", "gamma", "delta")) for _ in range(3))
    rows = [(1, a), (None, a.upper()), (None, b), (None, b), (None, b.title()), (2, c), (None, c + " end"), (None, None), (None, "  ")]
    rows = [(i, t, "en", f"s{n}", 1, 1, None) for n, (i, t) in enumerate(rows)]
    tables(spark, workdir, rows, [], [])
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    out = corpus_pipeline.near_stage(spark, docs, workdir)
    assert out.columns == docs.columns
    got = sorted(((x.doc_id, x.text) for x in out.collect()), key=repr)
    assert len(got) == 5 and (1, a) in got and (2, c) in got and (None, None) in got and (None, "  ") in got
    (rest,) = [t for i, t in got if i is None and t and t.strip()]
    assert rest.lower() == b.lower()


def test_stages_keep_columns_and_take_odd_tables(spark, workdir):
    odd = [(1, None, None, None, None, None, None), (None, "no id", "en", None, 5, 2, "x"), (None, None, None, "s", 0, 0, ""),
           (2, "", "en", "s", 0, 0, ""), (3, "same words here", "en", "s", 15, 0, ""), (3, "same words here", "en", "s", 15, 0, "")]
    for n, rows in enumerate(([], odd)):
        folder = f"{workdir}/o{n}"
        tables(spark, folder, rows, [], [(1, "x")])
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            assert docs.count() == len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0
        assert corpus_pipeline.run(spark, folder).count() >= 0
