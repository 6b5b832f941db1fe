import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe_lexicon, pretokens, token_counts, token_files
from millrace.llm.pretokens import Bpe, Merger, Pieces, default_tokenizer

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "x\n foo", "x\n\n foo", "x\n \nfoo", " \nfoo", "x \n", "x\t y", "x \t y", "tab\t\tz  ",
    "don't we'll I'M", "a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x", "naïve façade Ñandú", "日本語 テスト 12345", "😀 😀😀",
    "x  y  z", "x\x1c y\x85 z", "᠎ ​ ﻿ a", "%%% word,%%% A.B.C", "z" * 5000, "x don't. word'\nIt's word'\ns it''s a.b c.\n\nd É!\nü_ ' \n' q' s", "ab" * 300 + " " + "9" * 700, None, "\r\n \r\n  a\r",
]


def texts():
    rng = random.Random(5)
    letters = "abcdeé Ñ\n\t.,!'’  0129-_%x 日"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(300)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def test_merges(library):
    bpe = Bpe(default_tokenizer())
    merge = Merger(bpe, "H")
    words = [w for t in texts() for w, _ in library.pre_tokenizer.pre_tokenize_str(t or "")]
    want = [[x.id for x in library.model.tokenize(w)] for w in words]
    assert [np.frombuffer(x, "<u2").tolist() for x in merge(words)] == want
    assert merge([]) == [] and merge([""]) == [b""]
    for w, ids in zip(words, want):
        assert bpe.merge(w) == ids and bpe._merge_long([bpe.vocab[c] for c in w]) == ids


def test_bounded_tables(library):
    merge = Merger(Bpe(default_tokenizer()), "H")
    p = Pieces(default_tokenizer(), merge)
    p.entries = 3
    for _ in range(2):
        for k in range(0, 330, 7):
            some = [t or "" for t in texts()[k : k + 7]]
            ids, n = p.values(some)
            want = [library.encode(t, add_special_tokens=False).ids for t in some]
            assert n.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert p.size.data[: p.size.n].max() <= pretokens.KEPT


def test_pieces_whose_hashes_clash(library, monkeypatch):
    monkeypatch.setattr(pretokens, "_MIX", np.uint64(1 << 60))  # few hashes are left
    p = Pieces(default_tokenizer(), Merger(Bpe(default_tokenizer()), "H"))
    for _ in range(2):
        ids, n = p.values(texts())
        assert ids.tolist() == sum([library.encode(t or "", add_special_tokens=False).ids for t in texts()], [])
    assert len(set(p.hash.data[: p.hash.n].tolist())) == p.hash.n < 300


def test_random_texts(library):
    rng = random.Random(8)
    p = Pieces(default_tokenizer(), Merger(Bpe(default_tokenizer()), "H"))
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2009", "\u2028", "\u3000", "\ufeff", "\u1680", "\u180e", "a", "Z", "'s", "'ll", "'", ".", "”", "…", "é", "日", "7", "½", "<|endoftext|>", "ab", "\x00", "_", "😀", "\u0301"]
    for _ in range(60):
        some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]
        ids, n = p.values(some)
        at = 0
        for t, k in zip(some, n.tolist()):
            assert ids[at : at + k].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
            at += k


def test_counts(spark, library):
    rows = [(k, t, 1) for k, t in enumerate(texts())] + [(3, "again", 1), (3, "again", 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts.token_counts(df, limit=20).collect()))
    n = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted((k, len((t or "").encode()), n(t), n(t) > 20) for k, t, _ in rows if k is not None)
    piece = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df.limit(40), piece).collect()}
    assert got == {k: len(sp.encode(t or "")) for k, t, _ in rows[:40]}


def test_token_files(spark, library, tmp_path):
    rows = [(k * 7 % 331, t, "z") for k, t in enumerate(texts())] + [(5000, "twice", ""), (5000, "twice", ""), (None, "x", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string")
    token_files.SHARD_BYTES, was = 600, token_files.SHARD_BYTES
    token_files.write_token_files(df, str(tmp_path / "t"))
    token_files.SHARD_BYTES = was
    got = sorted(map(tuple, token_files.read_token_files(spark, str(tmp_path / "t")).collect()))
    want, at = [], 0
    for k, t, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    name, raw = token_files.read_dictionary(spark, str(tmp_path / "t"))
    shards = spark.read.parquet(str(tmp_path / "t/shards")).orderBy("part", "seq").collect()
    assert len(shards) > 3 and len(raw) > 0
    index = np.frombuffer(shards[1]["index"], token_files.ENTRY)
    doc = int(index["doc"][2])
    assert token_files.load_document(shards[1], 2, raw).tolist() == library.encode(dict((a, b) for a, b, _ in rows)[doc] or "", add_special_tokens=False).ids + [2]
    with pytest.raises(ValueError):
        token_files.load_document(shards[1], 2, raw + b"x")


def test_codec(spark, library):
    rows = [(k, t, "z") for k, t in enumerate(texts())] + [(2, "same", ""), (2, "same", ""), (None, "x", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for k, t, _ in rows:
        if k is not None:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((k, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    for most in (10, 5000):
        assert sorted(map(tuple, bpe_lexicon.bpe_codec(df, most=most).collect())) == sorted(want)
    full = {r.doc_id: r for r in bpe_lexicon.bpe_codec(df, texts=True).collect()}
    assert full[15].decoded == ODD[15] and full[15].ids == library.encode(ODD[15], add_special_tokens=False).ids


def test_lexicon_shares_suffixes(tmp_path):
    words = sorted({a + b for a in (b"walk", b"talk", b"\xff", b"stalk") for b in (b"", b"s", b"ed", b"ing")})
    data = bpe_lexicon.compile_lexicon([(w, bytes([k, 0] * (k % 3))) for k, w in enumerate(words)], 2)
    (tmp_path / "lex").write_bytes(data)
    for lex in (bpe_lexicon.Lexicon.open(str(tmp_path / "lex")),):
        assert [lex.get(w) for w in words] == [bytes([k, 0] * (k % 3)) for k in range(len(words))]
        assert lex.get(b"wal") is None and lex.get(b"walke") is None and lex.get(b"") is None and lex.get(b"q") is None
        assert lex.get_many([*words, b"wal", b"", b"walke"]) == [*(lex.get(w) for w in words), None, None, None]
        assert len(lex.final) < sum(map(len, words)) / 3
    (tmp_path / "none").write_bytes(bpe_lexicon.compile_lexicon([], 2))
    assert bpe_lexicon.Lexicon.open(str(tmp_path / "none")).get_many([b"a"]) == [None]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(df).count() == 0
    assert bpe_lexicon.bpe_codec(df).count() == 0
    token_files.write_token_files(df, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0
