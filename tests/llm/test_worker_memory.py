"""What Python workers hold while and after they work."""

import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers

from stategrid.llm import packing

REPO = str(Path(packing.__file__).parents[2])


def test_calls_of_the_tokenizer_are_bounded():
    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    words = list({"".join(rng.choices("abcdefghij", k=8)) for _ in range(7000)})
    sizes, call = [], e._of_call
    e._of_call = lambda ws: sizes.append(len(ws)) or call(ws)
    got = e([" ".join(words), "", words[0]])
    assert len(sizes) > 1 and max(sizes) <= packing.CALL
    assert got == [e._whole(t) for t in (" ".join(words), "", words[0])]


def test_spellings_of_a_word_are_one_part(monkeypatch):
    """Capitals and marks beside a word make no new strings to cut and remember."""
    cuts, words = [], packing._WORDS

    class Counting:
        findall = staticmethod(lambda t: cuts.append(t) or words.findall(t))
    monkeypatch.setattr(packing, "_WORDS", Counting)
    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(6)
    some = ["".join(rng.choices("abcdefghijé", k=7)) for _ in range(500)]
    texts = [" ".join(f"{w} {w.title()}, {w.upper()}. {w};" for w in some), " ".join(some)]
    assert e(texts) == [e._whole(t) for t in texts]
    assert len(cuts) < 10


def test_parts_are_cut_as_the_tokenizer_cuts(monkeypatch):
    """Also while strings are forgotten."""
    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(7)
    some = ["a", "I", "'s", "'ll", "'S", "'", "é", "Ž", "7", "42", "_", "×", ".", "...", ",", "!'", "(", " ", "  ", "\n", "\t",
            "don't", "x1y", "t", "re", "€", "“", "-", "<", "|", "\0", "ſ", "µ", "文", "\u00a0", "\x85", "\x1f"]
    monkeypatch.setattr(packing, "KNOWN", 50)
    for weights in ([9] * 31 + [0] * 6, [9] * 31 + [1] * 6):
        for _ in range(40):
            texts = ["".join(rng.choices(some, weights, k=rng.randrange(60))) for _ in range(25)]
            assert e(texts) == [e._whole(t) for t in texts]
            assert len(e.known.strings) <= 50
    monkeypatch.setattr(packing, "KNOWN_BYTES", 100)
    assert e(texts) == [e._whole(t) for t in texts]


PEAK = """
import random, resource, public_tokenizers
from stategrid.llm import common, packing
e = packing.encoder(public_tokenizers.path("word_bpe_49k.json"))
def peak(): return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
rng = random.Random(5)
base = peak()
for _ in range(4):
    e(["".join(rng.choices("abcdefghij    ", k=1 << 20)) for _ in range(3)])
    common.release_memory()
print(peak() - base)
"""


def test_new_words_take_little_memory():
    """12 MB of text in four calls, nearly all its words new."""
    out = subprocess.run([sys.executable, "-c", PEAK], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 256, out.stdout
