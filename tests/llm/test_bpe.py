import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadcast.llm import bpe

from .helpers import docs, odd_rows, table

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'", "r", "e", "s", " ", "é", "ab", "5", "-", "<|endoftext|>", "<|end", "́", "Σ", "日", "x" * 20, "\x1c", "\xa0"]


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(PATH)


def digests(lib, text):
    e = lib.encode(text or "", add_special_tokens=False)
    return (len(e.ids), hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest(),
            hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest())


def test_table_equals_the_library(spark, lib):
    rows = [(r[0], r[1]) for r in table(spark).select("doc_id", "text").collect()] + [r[:2] for r in odd_rows()]
    got = sorted((tuple(r) for r in bpe.tokenize(docs(spark, rows), PATH).collect()), key=str)
    assert got == sorted(((i, *digests(lib, t)) for i, t in rows), key=str)
    assert bpe.tokenize(docs(spark, []), PATH).count() == 0


def test_any_chunking_gives_the_same_ids(lib, vocab):
    for x in range(120):
        r = random.Random(x)
        s = "".join(r.choice(PARTS) for _ in range(r.randrange(1, 400)))
        enc, got, k = bpe.Encoder(vocab, {}), [], 0
        enc.hold = 700                       # above the lookahead, below most texts
        while k < len(s):
            j = k + r.randrange(1, 50)
            got += enc.feed(s[k:j])
            k = j
        assert got + enc.close() == lib.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 30000, "ab" * 20000 + "'s", "-'s" * 9000, "é" * 20000, "日本" * 9000,
                                  "😀" * 5000, "thequickbrownfox" * 3000, "<|endoftext|>" * 9000])
def test_words_without_end(lib, vocab, text):
    got = [i for part in bpe.encode(vocab, text, chunk=1500) for i in part]
    assert got == lib.encode(text, add_special_tokens=False).ids


def test_open_word_is_emitted_before_it_ends(vocab):
    enc = bpe.Encoder(vocab, {}, chunk=1000)
    early, most = 0, 0
    for _ in range(200):
        early += len(enc.feed("thequickbrownfox" * 20))
        most = max(most, len(enc.raw) + len(enc.text))
    assert early > 5000 and most <= 4 * enc.hold


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([("a", "b")]) == 1
    # a missing "d" frees c, then b and a: three rules deep
    assert bpe.sufficient_lookahead([("c", "d"), ("b", "c"), ("a", "b")]) == 3
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_text_decoder_gives_characters_once_complete(lib, vocab):
    text = "naïve café 日本語 😀 ok"
    ids = lib.encode(text, add_special_tokens=False).ids
    dec = bpe.TextDecoder(vocab)
    parts = [dec.feed([i]) for i in ids]
    assert "".join(parts) + dec.feed([], last=True) == "naïve café 日本語 😀 ok "
    assert not any("�" in p for p in parts)


def test_long_runs_of_every_character_of_the_alphabet(lib, vocab):
    """Tokens that never end where a character ends: cuts fall inside characters."""
    texts = [c * 2_000 for c in sorted({chr(x) for x in range(33, 0x3100, 7)} | set("▂กคおかるゕ"))]
    for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        assert [i for part in bpe.encode(vocab, text, chunk=1400) for i in part] == want.ids, text[0]


@pytest.mark.parametrize("text", ["▂" * 200_000, "ก" * 70_000, "word お" * 3 + "お" * 66_000 + " end", "かる" * 40_000 + "'s"])
def test_long_runs_at_the_real_limits(lib, vocab, text):
    assert [i for part in bpe.encode(vocab, text) for i in part] == lib.encode(text, add_special_tokens=False).ids


def test_random_periods(lib, vocab):
    r = random.Random(8)
    for _ in range(40):
        unit = "".join(chr(r.choice([r.randrange(97, 123), r.randrange(0xE00, 0xE4F), r.randrange(0x3041, 0x3097), r.randrange(0x2500, 0x2600)]))
                       for _ in range(2))
        text = unit * r.randrange(700, 2500)
        assert [i for part in bpe.encode(vocab, text, chunk=r.choice([300, 1500])) for i in part] == \
            lib.encode(text, add_special_tokens=False).ids, unit


def test_readable_text_of_the_table(spark, lib, vocab):
    rows = [r[:2] for r in odd_rows()] + [(40, "▂" * 3000), (41, "naïve café 日本語 😀 <|endoftext|> x")]
    got = {(r["doc_id"], r["n_tokens"], r["readable_sha256"]) for r in bpe.tokenize(docs(spark, rows), PATH, readable=True).collect()}
    want = set()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        data = b""
        for name in map(lib.id_to_token, ids):
            special = name.startswith("<|")
            body = name.removesuffix("</w>")
            data += name.encode() if special else bytes(vocab.byte_of[c] for c in body) + (b" " if body != name else b"")
        want.add((i, len(ids), hashlib.sha256(data.decode("utf-8", "replace").encode()).hexdigest()))
    assert got == want


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="not a lower-casing word BPE"):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_texts_at_once_equal_the_library_and_merge_a_word_once(lib, vocab, monkeypatch):
    r = random.Random(3)
    parts = [*PARTS, "word", "word.", "x1-y2", " ", "z" * 70, "\x85", "ǅ", "İ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(300)]
    pieces = bpe.Pieces(vocab)
    texts = [t for t in texts if pieces.fits(t)] + ["", " ", "word", " word. word "]
    met, plain = [], vocab.merge_many
    monkeypatch.setattr(vocab, "merge_many", lambda words: met.extend(words) or plain(words))
    for some in (texts[:150], texts[150:], texts):
        ids, at = pieces.encode(some)
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == \
            [e.ids for e in lib.encode_batch(some, add_special_tokens=False)]
    assert met and len(met) == len(set(met))
    assert not pieces.fits("a <|endoftext|>") and not pieces.fits("a" * bpe.CHUNK)


def test_pieces_are_forgotten_when_they_take_too_much(lib, vocab, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    pieces = bpe.Pieces(vocab)
    for k in range(30):
        texts = [f"wort{k} zahl{k}{c}, und mehr" for c in "abcde"]
        ids, at = pieces.encode(texts)
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert len(pieces.pieces) < 60


def test_short_and_cut_texts_in_one_batch(spark, lib):
    """Ids of rows that are looked up and of rows that go through the stream stand in their rows."""
    rows = [(k, t) for k, t in enumerate(["one two", "a<|endoftext|>b", None, "x" * 70_000, "", "two one.", "w " * 40_000, "日本 é"])]
    got = {x["doc_id"]: (x["ids"], x["n_tokens"]) for x in bpe.tokenize(docs(spark, rows), PATH, with_ids=True).collect()}
    want = {k: lib.encode(t or "", add_special_tokens=False).ids for k, t in rows}
    assert got == {k: (ids, len(ids)) for k, ids in want.items()}
