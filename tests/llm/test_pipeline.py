"""The pipeline keeps clean documents, drops and masks what it should, and places every piece."""

import random

import corpus_pipeline


def stages(spark, docs, upto):
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        yield name, docs
        if name == upto:
            return


def test_stages_decide(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    data = [(i, text(120), "en", f"s{i % 3}", 0) for i in range(60)]
    near = data[0][1].split(" ")
    near[60] = "changed"
    data += [
        (100, data[0][1], "en", "s0", 0), (101, " ".join(near), "en", "s1", 0), (102, "123 456", None, None, None),
        (103, None, None, None, None), (104, text(10), "en", "s0", 0), (105, "same words here " * 60, "en", "s0", 0),
        (106, text(120) + " jo@mail.example.com", "en", "s0", 0), (None, text(120), "en", "s0", 0), data[7]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    ids = {}
    for name, out in stages(spark, docs, "personal_data"):
        assert out.columns == docs.columns
        ids[name] = sorted(-1 if r.doc_id is None else r.doc_id for r in out.select("doc_id").collect())
    assert 102 not in ids["language"] and 103 not in ids["language"] and set(range(60)) <= set(ids["language"])
    assert not {104, 105} & set(ids["quality"]) and {*range(60), 100, 101, 106, -1} <= set(ids["quality"])
    assert ids["near_duplicates"] == sorted([-1, *range(60), 106])
    assert ids["personal_data"] == ids["near_duplicates"]


def test_run_on_the_given_tables(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.length > 0 and r.offset + r.length <= 4096 for r in rows)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, docs in stages(spark, docs, "packing"):
        assert docs.count() == 0
