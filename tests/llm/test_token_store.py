import numpy as np
import pytest

from chronovault.llm import token_store
from chronovault.llm.token_store import read_document, read_tokens, write_tokens
from chronovault.llm.wordbpe import default_tokenizer, word_bpe

from .helpers import corpus, empty, odd


@pytest.mark.parametrize("shard_tokens", [token_store.SHARD_TOKENS, 500])
def test_round_trip(spark, tmp_path, monkeypatch, shard_tokens):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", shard_tokens)
    frame, rows = odd(spark, corpus()[0])
    path = str(tmp_path / "store")
    write_tokens(frame.repartition(3), path)
    library, start = word_bpe(default_tokenizer()).tokenizer, 0
    got = {}
    for r in read_tokens(spark, path).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (start, len(ids), ids) in got[doc]
        start += len(ids)
    assert sum(map(len, got.values())) == len(rows)
    assert read_document(spark, path, 5) == [got[5][0][2], got[5][1][2]]
    assert read_document(spark, path, 103) == [got[103][0][2]]
    assert read_document(spark, path, 99) == []


def test_empty_table(spark, tmp_path):
    write_tokens(empty(spark), str(tmp_path / "store"))
    assert read_tokens(spark, str(tmp_path / "store")).collect() == []


def test_another_dictionary_is_refused(spark, tmp_path):
    import pyarrow as pa

    write_tokens(odd(spark)[0], str(tmp_path / "store"))
    shards = spark.read.parquet(str(tmp_path / "store/shards")).toArrow()
    batch = shards.append_column("start", pa.array([0] * shards.num_rows)).combine_chunks().to_batches()[0]
    with pytest.raises(ValueError):
        list(token_store.unpack_shards([batch], b"another"))
