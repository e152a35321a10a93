import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kithra.llm import tokenfiles
from kithra.llm.q_data import word_tokenizer
from kithra.session import scratch_path

ODD = [
    (7, None), (3, ""), (5, "Hello, World's 123 a.b!c don't O'Neil'S"), (1, "İstanbul STRASSE ÀÉ ÷× naïve ñandú"),
    (9, "á ȩ H̱ x"), (2, "日本語 text <|startoftext|> and <|endoftext|>!"), (2, "twice"), (2, "twice"),
    (None, "no key"), (11, " \t\n"), (4, " nbsp\u0085next\x1cgap x\x1fy"), (6, "word " * 30000), (8, "ﬁ ǅ ŉ µ ß ẞ Σας"),
]


def plain(text):
    return tokenfiles._tokenizer(word_tokenizer()).encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
@settings(max_examples=60, deadline=None)
def test_numbers_round_trip(numbers):
    control, data = tokenfiles.encode_numbers(np.array(numbers, np.uint32))
    assert tokenfiles.decode_numbers(control, data, len(numbers)).tolist() == numbers


@given(st.lists(st.text(alphabet=st.sampled_from("aZé'.,!1 \ń ßÄ÷İ<|>日s-\x1c"), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(texts):
    import pyarrow as pa

    got = [x.tolist() for x in tokenfiles.encode_texts(word_tokenizer(), pa.array(texts, pa.string()), True)]
    assert got == [plain(t) for t in texts]


@pytest.mark.parametrize("lower_words", [True, False])
def test_round_trip(spark, documents, lower_words):
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(documents(ODD), path, word_tokenizer(), lower_words=lower_words)
    rows = tokenfiles.read_tokens(spark, path).orderBy("start").collect()
    want = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [w[0] for w in want]
    start = 0
    for key in {w[0] for w in want}:
        got = sorted(r["ids"] for r in rows if r["doc_id"] == key)
        assert got == sorted(plain(w[1]) + [2] for w in want if w[0] == key)
    for r in rows:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        start += r["n_tokens"]
    ids = np.concatenate([r["ids"] for r in rows])
    vocabulary = tokenfiles.read_vocabulary(spark, path)
    count = np.bincount(ids)
    assert (np.diff(count[vocabulary]) <= 0).all()
    checks = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in tokenfiles.read_checks(spark, path).collect()}
    for r in rows:
        assert checks[r["doc_id"], r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_empty_table(spark, documents):
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(documents([(1, "x")]).limit(0), path, word_tokenizer(), lower_words=True)
    assert tokenfiles.read_checks(spark, path).collect() == []


MARKERS = ["<|", "|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "EndOfText", " ", "A", "1", "!", "é", "日"]


@given(st.lists(st.lists(st.sampled_from(MARKERS), max_size=6).map("".join), max_size=6))
@settings(max_examples=150, deadline=None)
def test_markers_of_any_case_give_the_ids_of_the_whole_text(texts):
    import pyarrow as pa

    texts = ["one <|ENDOFTEXT|> two", "Three<|EndOfText|>4", "<|endoftext|>", *texts, "<|StartOfText|>"]
    got = [x.tolist() for x in tokenfiles.encode_texts(word_tokenizer(), pa.array(texts, pa.string()), True)]
    assert got == [plain(t) for t in texts]


def test_ids_of_a_batch_are_handed_on_in_parts():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = np.array([chr(97 + k % 26) * (k % 5 + 1) + chr(97 + k // 26) for k in range(400)])
    texts = [" ".join(words[rng.integers(0, 400, 5000)]) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["key", "text"])
    path = word_tokenizer()
    expected = [zlib.crc32(np.array([*x, 2], "<u2").tobytes()) for x in tokenfiles.encode_texts(path, batch.column(1), True)]
    tracemalloc.start()
    try:
        parts = [(p.num_rows, p.column(0).to_pylist(), [zlib.crc32(x) for x in p.column(2).to_pylist()])
                 for p in tokenfiles.encoded_rows([batch], path, 2, True)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(parts) > 1
    assert [k for p in parts for k in p[1]] == list(range(400))
    assert [c for p in parts for c in p[2]] == expected
    assert peak < 15 * tokenfiles.SLICE_BYTES  # several arrays as long as a slice, none that holds a place for each id


def test_workers_give_memory_back_after_the_last_batch(monkeypatch):
    from kithra.llm import workers

    told = []
    monkeypatch.setattr(workers, "release", lambda: told.append("released"))

    def run(batches):
        for x in batches:
            told.append(x)
            yield x + 1

    assert list(workers.lean(run)(iter([1, 2]))) == [2, 3]
    assert told == [1, 2, "released"]
    monkeypatch.undo()
    workers.release()
