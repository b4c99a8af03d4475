import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.chunking import chunk_documents, window_spans
from tessera.operators.long_texts import DONE, Walk, chunk_files
from tessera.sources.ranges import read_range, read_text_ranges

LETTERS = "ab  \n\té€𝄞"


def _text(seed: int, size: int, letters: str = LETTERS) -> str:
    rnd = random.Random(seed)
    return "".join(rnd.choice(letters) for _ in range(size))


def _write(folder, texts: dict) -> str:
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return str(folder)


FILES = {"long.txt": _text(1, 6000), "no blanks.txt": "é" * 1500, "empty.txt": "", "blank.txt": "   \n ",
         "one window.txt": "x" * 40, "one more.txt": "x" * 41, "rare blanks%20.txt": _text(2, 2500, "a" * 60 + " ")}


@pytest.mark.parametrize("segment_bytes,fanout", [(164, 2), (165, 3), (1000, 64), (1 << 20, 64)])
def test_windows_of_files_equal_windows_of_whole_texts(spark, tmp_path, segment_bytes, fanout):
    path = _write(tmp_path, FILES)
    got = chunk_files(spark, path, 20, 2, 7, segment_bytes, fanout).collect()
    docs = spark.createDataFrame(list(FILES.items()), "doc_id string, text string")
    want = chunk_documents(docs, 20, 2, 7).collect()
    assert (sorted((os.path.basename(r.doc_id), *r[1:]) for r in got)
            == sorted((r.doc_id, *r[1:]) for r in want))


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=300), st.integers(1, 50))
def test_segments_joined_are_the_text(tmp_path_factory, text, step):
    path = os.path.join(_write(tmp_path_factory.mktemp("f"), {"t": text}), "t")
    size = os.path.getsize(path)
    parts = [read_range(path, a, min(a + step, size), 5) for a in range(0, size, step)]
    assert "".join(p[0] for p in parts) == text
    done = 0
    for part, ahead in parts:
        done += len(part)
        assert ahead == text[done:done + 5]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="a b", min_size=60, max_size=200), st.integers(20, 60), st.integers(0, 19))
def test_passage_from_every_begin(text, cut, overlap):
    """Each begin's passage is what the plain walk over the rest of the text does."""
    window = 20
    after, counts = Walk(text[:cut], text[cut:cut + window], window, overlap).passage()
    for begin in range(min(window - overlap, cut)):
        begins = [begin + a for a, _ in window_spans(text[begin:], window, overlap)]
        later = [b for b in begins if b >= cut]
        assert after[begin] == (later[0] - cut if later else DONE)
        assert counts[begin] == len(begins) - len(later)


def test_no_files_and_segments_that_hold_no_window(spark, tmp_path):
    path = _write(tmp_path, {"empty.txt": ""})
    assert chunk_files(spark, path, 20, 2, 7, 200).count() == 0
    with pytest.raises(ValueError):
        chunk_files(spark, path, 20, 2, 7, 100)


def test_text_ranges_of_all_files(spark, tmp_path):
    path = _write(tmp_path, FILES)
    rows = sorted(read_text_ranges(spark, path, 333).collect(), key=lambda r: r.segment_no)
    joined = {}
    for r in rows:
        name = os.path.basename(r.file_path)
        joined[name] = joined.get(name, "") + r.text
    assert joined == {k: v for k, v in FILES.items() if v}


def test_passages_leave_a_few_at_a_time(tmp_path, monkeypatch):
    import pandas as pd
    from tessera.operators import long_texts as LT
    path, size = str(tmp_path / "a.txt"), 300
    with open(path, "w") as out:
        out.write("ab cde " * 600)
    n = 600 * 7 // size
    ranges = pd.DataFrame([(path, n, i, i * size, (i + 1) * size) for i in range(n)],
                          columns=["file_path", "n_segments", "segment_no", "byte_start", "byte_end"])
    monkeypatch.setattr(LT, "FLUSH_BYTES", 12 * 40 * 3)
    frames = list(LT._segment_passages(50, 10)(iter([ranges])))
    assert max(map(len, frames)) == 3 and len(frames) > 4
    alone = [f for i in range(n) for f in LT._segment_passages(50, 10)(iter([ranges[i:i + 1]]))]
    whole = pd.concat(frames, ignore_index=True)
    assert whole.to_dict("records") == pd.concat(alone, ignore_index=True).to_dict("records") and len(whole) == n
