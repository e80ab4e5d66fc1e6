"""A token worker holds few texts as Python strings."""

import pyarrow as pa

from motorlake.llm import common


def test_texts_become_strings_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(common, "BATCH_TEXTS", 3)
    rows = [(i, None if i == 4 else f"t{i}") for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(["x"] * 8)], names=["doc_id", "text", "more"])
    assert list(common.id_texts(batch)) == rows and list(common.id_texts(batch.slice(0, 0))) == []
    held = []
    batch_of = lambda at, n: held.append(n) or batch.slice(at, n)
    watched = type("Watched", (), {"num_rows": 8, "column": lambda self, i: type("Column", (), {"slice": lambda c, at, n: batch_of(at, n).column(i)})()})()
    assert list(common.id_texts(watched)) == rows and set(held) == {3}


def test_the_pipelines_pack_stage_keeps_fewer_entries():
    import public_tokenizers

    import corpus_pipeline
    ids = common.TokenIds(public_tokenizers.path("byte_bpe_50k.json"), True, 40)
    assert ids._rest._entries == ids._first._entries == 40 and ids._rest._pieces._entries == 20
    text = " ".join(f"w{i} word{i}." for i in range(300))
    assert ids.of(text) == ids.whole(text) and len(ids._rest) <= 40 and len(ids._rest._older) <= 40
    assert corpus_pipeline.PACK_CACHE < common.CACHE_ENTRIES
