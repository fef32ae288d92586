import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, hard_texts

from tallyrec.llm.bpe import Codec, decode_documents, encode_documents, read_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )


@pytest.fixture(scope="module", params=[RANKS, MULTI])
def pair(request):
    return Codec(read_ranks(request.param), public_tokenizers.PATTERN), library(request.param)


def agree(pair, texts):
    codec, other = pair
    for text, (ids, decoded) in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert decoded == text.encode()


HARD = ["", "a", " ", " a", "a ", "  ", "a  b", "a \n b", "\n", "x\n\n y  z ", "it's I'll  don't", "a b\n", "b\n c"]
HARD += ["\x1c \x1c a", "a　 b  c", "日本語 テスト", "🙂🙂 🙂", "<|endoftext|> hi", "\x85 a", "1 2  3 "]
HARD += ["= " * 50 + "=" * 777 + "ab" * 400, "aé" * 300, "-" * 3000 + "x", "abcdefghij" * 60, " \xa0a  b"]


def test_hard_texts(pair):
    agree(pair, HARD + [t or "" for _, t in hard_texts()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\x0b'sdlré1.日🙂\x1c\xa0Aab"), max_size=40), max_size=20))
def test_any_texts(pair, texts):
    agree(pair, texts)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=10))
def test_any_characters(pair, texts):
    agree(pair, texts)


def test_long_pieces(pair):
    rng = random.Random(6)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    syllables = "".join(rng.choice(["the", "ing", "ation", "ly", "re", "un"]) for _ in range(3_000))
    agree(pair, [letters, "x " + letters[:5000] + " y", syllables, "a" * 20_000, "é" * 9_000])


def test_segments_are_independent(pair):
    codec, _ = pair
    rng = random.Random(8)
    for _ in range(40):
        piece = "".join(rng.choice("etaoinqxzj") for _ in range(200)).encode()
        segments = codec._segments(piece)
        assert b"".join(segments) == piece and all(segments)
        parts, decoded = codec.encode_pieces(list(dict.fromkeys(segments)))
        own = dict(zip(dict.fromkeys(segments), parts))
        whole = pair[1].encode_ordinary(piece.decode())
        assert np.frombuffer(b"".join(own[s] for s in segments), "<u4").tolist() == whole


def test_memory_lasts_and_is_bounded(pair, monkeypatch):
    codec, _ = pair
    texts = [" ".join(f"w{i}x{j}, plain{'abcdef'[j % 6]}" for j in range(300)) for i in range(6)]
    agree(pair, texts)
    held = sum(map(len, codec.ids))
    codec.release()
    calls = []
    monkeypatch.setattr(codec, "encode_pieces", lambda pieces: calls.extend(pieces) or ([], []))
    agree(pair, texts)
    assert not calls and sum(map(len, codec.ids)) == held
    monkeypatch.undo()
    codec._drop_older_half()
    assert sum(map(len, codec.ids)) <= held // 2 + 3 and codec.held > 0
    agree(pair, texts)


def test_forgetting_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr("tallyrec.llm.bpe.CACHED_CHUNKS", 3)
    for _ in range(3):
        agree(pair, HARD)


def test_tables(spark):
    rows = hard_texts()
    df = spark.createDataFrame(documents(rows))
    other = library(RANKS)
    found = encode_documents(df, RANKS, public_tokenizers.PATTERN).collect()
    wanted = [(d, other.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows]
    got = [(r.doc_id, r.ids, bytes(r.decoded)) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert all(r.n_tokens == len(r.ids) for r in found)
    digests = ("n_tokens", "ids_sha256", "decoded_sha256")
    short = encode_documents(df, RANKS, public_tokenizers.PATTERN, digests).collect()
    sums = [
        (d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t).hexdigest())
        for d, i, t in wanted
    ]
    assert sorted(map(tuple, short), key=repr) == sorted(sums, key=repr)
    assert encode_documents(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding(spark):
    rows = [(1, [464, 3290, 0]), (2, []), (3, None), (None, [220, 99999])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r.doc_id: bytes(r.decoded) for r in decode_documents(df, RANKS).collect()}
    assert found == {1: library(RANKS).decode_bytes([464, 3290, 0]), 2: b"", 3: b"", None: b" "}


# a task's texts, and the memory in MB that a worker has more for them at most, and after the task
WORKER = """
import random, re, threading, time
import duckdb, numpy, public_tokenizers, pyarrow
from pathlib import Path
from tallyrec.llm.bpe import Codec, read_ranks

def used():
    found = re.search(r"Anonymous:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found[1]) / 1024

rng = random.Random(5)
words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 12))) for _ in range(60_000)]
texts = [" ".join(rng.choices(words, k=500)) for _ in range(2_000)]
codec = Codec(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
before, most = used(), [0]

def watch():
    while True:
        most[0] = max(most[0], used())
        time.sleep(0.02)

threading.Thread(target=watch, daemon=True).start()
for ids, decoded in codec.encode(texts):
    pass
codec.release()
print(most[0] - before, used() - before)
"""


def test_memory_of_a_worker():
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)}
    found = subprocess.run([sys.executable, "-c", WORKER], capture_output=True, check=True, env=env)
    most, after = map(float, found.stdout.split())
    assert most < 100 and after < 50


def test_slices_of_any_size(spark):
    docs = spark.createDataFrame(documents(hard_texts())).coalesce(1)
    small, whole = (
        encode_documents(docs, RANKS, public_tokenizers.PATTERN, slice_bytes=size).collect() for size in (1, 8 << 20)
    )
    assert whole == small and len(whole) == docs.count()
