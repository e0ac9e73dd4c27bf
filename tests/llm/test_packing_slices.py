"""What a worker of the packing holds at once."""

import pyarrow as pa

from ledgerleaf.llm import packing


def test_texts_are_encoded_in_slices_of_two_mebibytes():
    texts = [b"some words of a text " * 5000] * 60
    rows = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "text_utf8"])
    made = list(packing._encoded(packing.tokenizer_path(), "<u2", packing.WINDOW, packing.END_ID)(iter([rows])))
    assert sum(b.num_rows for b in made) == 60
    assert max(sum(len(texts[i]) for i in b.column("doc_id").to_pylist()) for b in made) <= 2 << 20
