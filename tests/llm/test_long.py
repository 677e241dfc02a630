"""What one very long text costs a Python worker, in a process of its own."""

import subprocess
import sys

import pytest

CODE = """
import resource, sys
import numpy as np, pyarrow as pa
from sedimenta.llm import bpe, crf, html_extract, near_dup, quality, toxicity

base = " ".join(f"word{i % 5000} text" if i % 9 else "line\\n" for i in range(700_000))
text = (base * 8)[: 64 << 20]
assert len(text) == 64 << 20
rng, path = np.random.default_rng(3), bpe.tokenizer_path()
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
del base, text
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
out = {
    "op5": lambda: bpe._encoder(path, False)(iter([batch])),
    "op6": lambda: quality._scorer(quality.Model(crf.Chain(dense=rng.normal(size=72)), np.array([0.1, 0.2, 0.3, 0.0]), 0.5))(iter([batch])),
    "op7": lambda: near_dup._classify(2)(iter([batch.select(["text", "doc_id"])])),
    "op8": lambda: toxicity._scorer(toxicity.Model(crf.Chain(sparse=rng.normal(size=1 << 20) - 3), np.array([0.1, 0.2, 0.3]), 0.5), 0.5)(iter([batch])),
    "op9": lambda: bpe.piece_maker(path, 4096, 1)(iter([batch])),
    "op10": lambda: bpe.token_counter(path)(iter([batch])),
}[sys.argv[1]]()
assert sum(len(b) for b in out) >= 1
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("op", ["op5", "op6", "op7", "op8", "op9", "op10"])
def test_memory_of_a_text_of_64_mib(op):
    """Beyond what the text itself takes: 700 MB at most."""
    done = subprocess.run([sys.executable, "-c", CODE, op], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 700


KEPT = """
import numpy as np, pyarrow as pa
from sedimenta.llm import near_dup

def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

def batches():
    for k in range(6):
        yield pa.RecordBatch.from_arrays([pa.array([f"w{k} " + " ".join(f"x{(i * 7 + j) % 9973}" for j in range(600)) for i in range(5000)])], ["text"])

next(near_dup._classify(5)(batches()))
before = held()
assert sum(len(b) for b in near_dup._classify(5)(batches())) == 30_000
print(held() - before)
"""


def test_a_worker_gives_memory_back_when_a_task_is_done():
    """After 90 MB of texts a worker that waits holds little more than before."""
    done = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 40


def test_windows_of_one_sequence_give_the_whole_result():
    import numpy as np

    from sedimenta.llm import crf

    rng = np.random.default_rng(6)
    scores, w = rng.normal(size=5000) * 3, np.exp(rng.normal(size=(2, 2)))
    whole = crf.posterior(scores, np.array([0, 5000]), w)[0]
    for window in (1, 7, 512, 5000):
        if window == 1:
            part = scores[:60]
            got = np.concatenate([p for _, _, p in reversed(list(crf.posterior_windows(part, w, 1)))])
            assert np.allclose(got, crf.posterior(part, np.array([0, 60]), w)[0])
            continue
        got = np.concatenate([p for _, _, p in reversed(list(crf.posterior_windows(scores, w, window)))])
        assert np.allclose(got, whole)


def test_classifiers_agree_whatever_the_windows(monkeypatch):
    import numpy as np

    from sedimenta.llm import crf, quality, toxicity, vectext

    rng = np.random.default_rng(9)
    text = "\n".join(" ".join(f"w{k}é" for k in rng.integers(0, 50, int(rng.integers(0, 30)))) for _ in range(300)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    good = quality.Model(crf.Chain(dense=rng.normal(size=72)), np.array([0.1, 0.2, 0.3, 0.0]), 0.5)
    bad = toxicity.Model(crf.Chain(sparse=rng.normal(size=1 << toxicity.TABLE_BITS) * 2), np.array([0.1, 0.2, 0.3]), 0.5)
    spans = lambda: toxicity._spans(*bad.score(data, offsets)[1:])
    want = good.score(data, offsets), bad.score(data, offsets)[0], spans()
    assert want[2][0]
    monkeypatch.setattr(quality, "WINDOW", 16)
    monkeypatch.setattr(toxicity, "WINDOW", 37)
    monkeypatch.setattr(quality.Lines.ranges, "__defaults__", (5,))
    assert np.allclose(good.score(data, offsets), want[0]) and np.allclose(bad.score(data, offsets)[0], want[1])
    got = spans()
    assert [[(s["start"], s["stop"]) for s in t] for t in got] == [[(s["start"], s["stop"]) for s in t] for t in want[2]]
    monkeypatch.setattr(vectext, "WINDOW", 64)
    vectext._powers.clear()
    try:
        assert np.allclose(good.score(data, offsets), want[0]) and np.allclose(bad.score(data, offsets)[0], want[1])
    finally:
        vectext._powers.clear()
