"""Token counts and packing against the tokenizers library itself."""
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import encoding, packing, token_counts

from .conftest import EDGE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return encoding.tokenizer(encoding.public())


def test_every_plain_character(library, own):
    """The fast path agrees with the library on every character it takes, in four places."""
    chars = [c for c in map(chr, range(0x2100)) if not 0xD800 <= ord(c) < 0xE000 and not encoding.PLAIN.search(c)]
    assert len(chars) > 1500
    for lo in range(0, len(chars), 50):
        text = "".join(f"a{c}b {c} 1{c}{c} \n{c}'s" for c in chars[lo:lo + 50])
        assert own.plain(text)
        assert own.encode(text).tolist() == library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    from tokenizers import Tokenizer

    t = test_any_text.__dict__.setdefault("t", Tokenizer.from_file(P.path("byte_bpe_50k.json")))
    assert encoding.tokenizer(encoding.public()).encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_documents(spark, library, own):
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        assert own.encode(r.text or "").tolist() == library(r.text or "")


def test_counts_and_cache(spark, docs_of, library, tmp_path):
    v, cache = encoding.public(), str(tmp_path / "cache")
    want = sorted(((i, len((t or "").encode()), n := len(library(t or "")), n > 1024) for i, t in EDGE), key=str)
    for _ in range(2):  # the second run finds every count in the cache
        got = token_counts.count_tokens(docs_of(EDGE), v, cache=cache).collect()
        assert sorted(map(tuple, got), key=str) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in EDGE}) == stored.select("digest").distinct().count()
    more = [*EDGE, (99, "something new")]
    assert token_counts.count_tokens(docs_of(more), v, cache=cache).count() == len(more)
    assert spark.read.parquet(cache).count() == stored.count() + 1
    # An append that a repeated run made twice is read once.
    spark.read.parquet(f"{cache}/version={v.version}").limit(5).write.mode("append").parquet(f"{cache}/version={v.version}")
    assert token_counts.count_tokens(docs_of(more), v, cache=cache).count() == len(more)


def test_other_vocabularies(spark, docs_of):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    sp, wb = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    small = [(i, (t or "")[:500]) for i, t in EDGE]
    for name, count in (("piece_bpe_32k.model", lambda t: len(sp.encode(t))), ("word_bpe_49k.json", lambda t: len(wb.encode(t, add_special_tokens=False).ids))):
        got = token_counts.count_tokens(docs_of(small), encoding.public(name)).collect()
        assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(((i, count(t)) for i, t in small), key=str)


def check_pieces(rows, documents, window=1024, repeated=False):
    """Every id in exactly one piece, sequences gapless, padding none."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        if not repeated:
            ids = documents[r.doc_id][r.start:r.start + r.length]
            assert len(ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            assert r.doc_tokens == len(documents[r.doc_id])
    if not repeated:
        assert by_doc.keys() == documents.keys()
        for d, pieces in by_doc.items():
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
            assert at == len(documents[d])
    padded = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    assert padded == 0


def test_pack_edges(spark, docs_of, library):
    documents = {i: library(t or "") + [0] for i, t in EDGE if i not in (6, None)}
    got = packing.pack(docs_of([r for r in EDGE if r[0] not in (6, None)]), encoding.public()).collect()
    check_pieces(got, documents)
    got = packing.pack(docs_of(EDGE), encoding.public(), with_ids=True).collect()
    check_pieces(got, {}, repeated=True)
    assert sum(r.length for r in got) == sum(len(library(t or "")) + 1 for _, t in EDGE)
    assert all(len(r.ids) == r.length for r in got)
    assert packing.pack(docs_of([]), encoding.public()).collect() == []


def test_pack_documents(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(3)
    documents = {r.doc_id: library(r.text or "") + [0] for r in docs.collect()}
    check_pieces(packing.pack(docs, encoding.public()).collect(), documents)


def test_level_choice_is_the_smallest_sum_of_squares():
    random.seed(3)
    p = packing.Packer(64)
    for doc in range(3000):
        size = random.choice((5, 9, 17, 23, 31, 40, 63))
        count = p.count.copy()

        def after(level):
            c = count.copy()
            if level:
                c[level] -= 1
            if level + size < 64:
                c[level + size] += 1
            return int((c * c).sum())

        levels = [0, *[h for h in range(1, 65 - size) if count[h]]]
        chosen = p.choose(size)
        assert after(chosen) == min(map(after, levels))
        list(p.place(doc, np.arange(size, dtype="<u4")))
        assert p.n_open == p.count.sum() == sum(map(len, p.open))


@pytest.mark.parametrize("most", [2, 8192])
def test_packer_bound(most):
    random.seed(4)
    p, seen = packing.Packer(64, most), {}
    sizes = [random.randint(1, 200) for _ in range(500)]
    sequences = [s for d, n in enumerate(sizes) for s in p.place(d, np.arange(n, dtype="<u4"))] + list(p.finish())
    for s in sequences:
        total = sum(len(ids) for _, _, ids, _ in s)
        assert total == 64 or total & (total - 1) == 0
        for d, start, ids, n in s:
            assert n == sizes[d] and ids.tolist() == list(range(start, start + len(ids)))
            seen.setdefault(d, []).extend(ids.tolist())
    assert all(sorted(seen[d]) == list(range(n)) for d, n in enumerate(sizes))
