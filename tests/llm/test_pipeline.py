"""The five stages one after the other, on tables with nulls, empty texts, repeated rows, copies and passages of the benchmark."""

import random
import weakref

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tracewell.llm.common import drop_tables
from tracewell.llm.ngram_join import word_hashes
from tracewell.llm.queries import VOCABULARY
from tracewell.llm.token_files import encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, rows, labels, bench):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(31)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choices(words, k=n))
    rows, labels = [], []
    for i in range(150):
        good = i % 4 != 0
        text = sentence(60) if good else "\n".join([" ".join(w + "###" for w in sentence(20).split())] * 4)
        rows.append((i, text, "en", "abc"[i % 3], 1))
        labels.append((i, int(good), 0))
    passage = sentence(40)
    rows += [(200, rows[1][1], "en", "a", 1), (201, rows[1][1] + " end", "en", "b", 1), (202, sentence(20) + " " + passage + " " + sentence(20), "en", "c", 1)]
    rows += [(203, None, None, None, None), (204, "", "en", "a", 0), (None, sentence(50), "en", None, 1), (None, None, None, None, None), rows[2], rows[2]]
    return rows, [*labels, (None, 1, 0), (5, None, None)], [(1, passage), (None, None), (2, "short")]


def test_stages_in_a_row(spark, tables, tmp_path):
    rows, labels, bench = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    folder = write(spark, tmp_path, rows, labels, bench)
    out = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert corpus_pipeline.run(spark, folder).count() == len(out)  # reruns agree
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {}
    for d, t, *_ in rows:
        sizes.setdefault(d, set()).add(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1)
    start = 0
    for r in out:
        assert r["start"] == start and r["n_tokens"] in sizes[r["doc_id"]]
        start += r["n_tokens"]
    ids = {r["doc_id"] for r in out}
    bad = {i for i in range(0, 150, 4)}
    assert not ids & bad and not ids & {202}  # bad lines, and a passage of the benchmark
    assert not ids & {200, 201}  # the smallest id of a group stays
    assert len(ids) > 20


def test_stages_of_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_return_the_columns_of_documents(spark, tables, tmp_path, stage):
    rows, labels, bench = tables
    folder = write(spark, tmp_path, rows[:20], labels, bench)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.STAGES[stage][1](spark, docs, folder).columns == docs.columns


def test_a_worker_holds_the_tables_of_one_operator():
    path = public_tokenizers.path(VOCABULARY)
    encoder(path)("some words of a text")
    left = weakref.ref(encoder(path))
    assert encoder(path) is left()  # for later tasks of the same operator
    word_hashes()[b"word"]
    assert left() is None
    assert word_hashes() is word_hashes() and b"word" in word_hashes()
    left = weakref.ref(word_hashes())
    drop_tables()
    assert left() is None
