"""What weighing holds: a few rows at a time, and no hash of the whole vocabulary."""

import pyarrow as pa
import pyarrow.compute as pc

from corpuscope.operators import terms as module


def weighed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "row_id long, page_content string")
    rows = module.vectors(docs, module.fit(docs)).collect()
    return {r.row_id: (r.terms, [round(w, 12) for w in r.weights]) for r in rows}


def test_pieces_of_a_batch_weigh_the_same(spark, monkeypatch):
    texts = ["a b a c", "", None, " ".join(f"w{i}" for i in range(50)), "b b", "a z w3", "c"]
    whole = weighed(spark, texts)
    assert whole[3][0] == sorted(f"w{i}" for i in range(50)) and whole[1] == ([], [])
    monkeypatch.setattr(module, "_ENTRIES", 4)
    assert weighed(spark, texts) == whole


def test_pieces_are_whole_rows_of_few_counts(monkeypatch):
    monkeypatch.setattr(module, "_ENTRIES", 5)
    lists = pa.array([[1, 2], [3], None, [], [4, 5, 6], list(range(9)), [7]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([lists], names=["counts"])
    found = list(module._pieces(batch))
    assert pa.Table.from_batches(found)["counts"].to_pylist() == lists.to_pylist()
    sizes = [(p.num_rows, pc.sum(pc.list_value_length(p["counts"])).as_py()) for p in found]
    assert all(rows == 1 or n <= 5 for rows, n in sizes) and len(found) == 4
    assert not list(module._pieces(batch.slice(0, 0)))


def test_only_the_texts_are_hashed(monkeypatch):
    hashed, plain = [], pc.index_in
    monkeypatch.setattr(
        module.pc, "index_in", lambda a, value_set: (hashed.append(len(value_set)), plain(a, value_set=value_set))[1]
    )
    known = pa.array([f"w{i}" for i in range(1000)])
    assert module._codes(pa.array(["w7", "x", "w7", "w999"]), known).tolist() == [7, -1, 7, 999]
    assert hashed == [3]
    assert module._codes(pa.array([], pa.string()), known).tolist() == []
    assert module._codes(pa.array(["a"]), pa.array([], pa.string())).tolist() == [-1]
