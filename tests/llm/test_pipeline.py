from __future__ import annotations

import random

import corpus_pipeline
import pytest
from test_packing import check_sequences
from test_quality import invented as invented_quality
from test_simhash import brute_components, plain_fingerprint
from test_toxicity import invented as invented_toxicity
from tokenizers import Tokenizer

from lexmill.llm import packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    draw = random.Random(12)
    rows, labels = [], []
    for n in range(240):
        toxic, good = n % 4 == 0, n % 5 != 0
        text = invented_toxicity(draw, True) if toxic else invented_quality(draw, good)
        text = f"{text} {n} {draw.random()} ended."
        rows.append(text)
        labels.append((n, int(good or toxic), int(toxic)))
    copies = [rows[1] + " \n", rows[1], rows[2].replace(" ", "  "), rows[3].replace("river", "River"), rows[7]]
    texts = [*rows, *copies, None, "", "river " * 6000 + "end."]
    folder = str(tmp_path_factory.mktemp("tables"))
    documents = [(n, text, "en", "s", len(text or "")) for n, text in enumerate(texts)]
    documents += [(None, "no id for this text of the river.", None, None, None), documents[6]]
    spark.createDataFrame(documents, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def staged(spark, folder: str) -> list:
    """The output of each stage, as the driver runs them: written and read again."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{folder}/out-{number}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        found.append(docs)
    return found


def test_stages(spark, tables):
    start = spark.read.parquet(f"{tables}/documents.parquet")
    clean, good, distinct, single, packed = staged(spark, tables)
    assert all(frame.columns == start.columns for frame in (clean, good, distinct, single))
    rows = [[(r.doc_id, r.text or "") for r in frame.collect()] for frame in (start, clean, good, distinct, single)]
    kept = [{doc_id for doc_id, _ in part} for part in rows]
    planted = {n for n in range(240) if n % 4 == 0}
    assert len(planted & kept[1]) <= 2 and len(kept[0] - kept[1] - planted) <= 3
    junk = {n for n in range(240) if n % 5 == 0 and n % 4}
    assert len(junk & kept[2]) <= 3 and len((kept[1] - kept[2]) - junk) <= 12

    best: dict = {}
    for doc_id, text in rows[2]:
        key = "".join(c for c in text if c not in " \t\n\x0b\x0c\r")
        best.setdefault(key, []).append((-len(text), doc_id is None, doc_id))
    survivors = {min(group)[2] for group in best.values()}
    assert kept[3] == survivors

    ids = [doc_id for doc_id, _ in rows[3]]
    components = brute_components([plain_fingerprint(text) for _, text in rows[3]], ids)
    assert kept[4] == {i for i, c in zip(ids, components) if i is None or c is None or i == c}

    model = Tokenizer.from_file(packing.VOCABULARY_PATH)
    wanted = sorted((str(i), len(model.encode(t, add_special_tokens=False).ids) + 1) for i, t in rows[4])
    lengths: dict = {}
    pieces = packed.collect()
    check_sequences([(r.sequence_id, r.offset, r.length) for r in pieces], packing.Capacity())
    for r in pieces:
        lengths[str(r.doc_id)] = lengths.get(str(r.doc_id), 0) + r.length
    totals: dict = {}
    for doc_id, length in wanted:
        totals[doc_id] = totals.get(doc_id, 0) + length
    assert lengths == totals
    ran = corpus_pipeline.run(spark, tables)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(str, ran.select(*columns).collect())) == sorted(map(str, packed.select(*columns).collect()))


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
