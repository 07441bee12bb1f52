"""What the joining worker of the BPE operator holds at a time, without Spark."""

import numpy as np
import pytest

bpe = pytest.importorskip("millrace.llm.bpe")
from millrace.llm import pretokens  # noqa: E402


def test_a_row_of_codes_is_a_bounded_part_of_its_block():
    block, words = bpe._Block(), [f"w{i}" for i in range(100)]
    codes = np.arange(400_000) % 100
    first = np.arange(0, 400_001, 1000)
    block.add(list(range(400)), pretokens.Words(codes, first, words), 1_000_000)
    rows = [b for b in block.rows(0, 8) if b.column("kind")[0].as_py() == bpe.CODES]
    counts = [int.from_bytes(b.column("payload")[0].as_py()[:4], "little") for b in rows]
    assert sum(counts) == 400 and max(counts) * 1000 * 4 <= (1 << 20) + 4000  # one document more than fits, at most


def test_a_block_takes_as_many_texts_as_share_their_words_well(monkeypatch):
    pyspark, pa = pytest.importorskip("pyspark"), pytest.importorskip("pyarrow")
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(pretokens, "split", lambda strings, path, kind: pretokens.Words(
        np.zeros(len(strings), np.int64), np.arange(len(strings) + 1), ["word"]))
    texts = ["x" * (1 << 20)] * 20  # 20 million characters: more than two blocks of 8
    batches = (pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]}) for i, t in enumerate(texts))
    words = [b for b in bpe._split(batches, None, "clip", 8) if b.column("kind")[0].as_py() == bpe.WORDS]
    assert len(words) == 1
