import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import token_files
from frostline.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_encode_like_whole_texts(tokenizer):
    rng = random.Random(1)
    parts = list("ab ,.'s  \n\t\r1é😀  #") + ["<|endoftext|>", "   ", "'ll", " \n", " word", "!!", "***", "\x1c", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = token_files.Encoder(tokenizer_path())
    found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert found == want
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want  # from what it remembers


def test_pieces_that_were_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 300)
    rng = random.Random(2)
    parts = ["alpha", "béta", ",", "...", " ", " ", "\n", "\n\n", "\0", "\u3000", "_x", "½", "7", "<|endoftext|>", "語"]
    encoder = token_files.Encoder(tokenizer_path())
    for _ in range(40):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(50)]
        want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(texts)] == want
    assert len(encoder.older.number) > 300


@pytest.mark.parametrize("length,batch", [(8, 2), (2048, 64)])
def test_round_trip(documents, tokenizer, length, batch):
    rows = [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]
    ids = {t: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for _, t in rows}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode()), len(r[1])))
    want, start = [], 0
    for i, t in rows:
        crc = zlib.crc32(np.array(ids[t], "<u4").tobytes())
        want.append((i, start, len(ids[t]), crc))
        start += len(ids[t])
    found = token_files.token_files(
        documents, tokenizer_path=tokenizer_path(), end_id=2, length=length, batch_sequences=batch
    ).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want


def test_files_are_fixed_size_lists_with_masks(documents, spark):
    import pyarrow as pa

    folder = spark.conf.get("spark.checkpoint.dir") + "/token-files"
    index = token_files.write_tokens(documents, folder, tokenizer_path=tokenizer_path(), end_id=2, length=64)
    for r in index.groupBy("path").agg(F.sum("n_tokens").alias("n")).collect():
        with pa.memory_map(r["path"].removeprefix("file://")) as source:
            table = pa.ipc.open_file(source).read_all()
        assert table.schema.field("ids").type == pa.list_(pa.uint16(), 64)
        mask = table["mask"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        assert mask[: r["n"]].all() and not mask[r["n"] :].any()


def test_no_documents(no_documents):
    found = token_files.token_files(no_documents, tokenizer_path=tokenizer_path(), end_id=2)
    assert found.count() == 0
