r"""Operator 3: BPE encoding and decoding as streaming transducers.

Encoding.  Texts that fit a chunk are final as a whole: ``Pieces`` encodes many of
them at once, each piece between spaces a single time.  A longer text goes through the normaliser, the word splitter and the merge
list in chunks.  Tokens are emitted as soon as nothing that may follow can
change them:

* a word that has ended is final;
* inside a word that is still open (a run of letters without end), the merge
  list's *sufficient lookahead* tells how many symbols beyond a token must be
  known.  A missing continuation can only take the last token ``u`` before the
  known end away (rule ``u v`` applied across the end), later the token before
  that through a rule of higher rank whose right part begins with what was
  left standing, and so on.  The longest such chain of rules, weighted by the
  length of the left parts, bounds how far a change travels to the left; it is
  computed once from the merge list in rank order.

A cut at a stable token boundary splits the word: no merge crosses it, so the
rest encodes on its own.  It may fall inside a character: then the symbols that
are left of the character are carried before the rest.  The buffer therefore never exceeds a chunk plus the
lookahead, whatever the text (combining marks without a base excepted: the
normaliser itself has to see such a run whole).

Decoding.  ``Decoder`` joins the vocabulary strings as the library does when a
tokenizer file names no decoder (``decoded_sha256``); ``TextDecoder`` is the
byte-to-text state machine: it turns ids into bytes, word ends into spaces, and
emits characters once their UTF-8 sequence is complete (``readable_sha256``).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
_NONE, _SLOTS, _SPREAD = 1 << 30, (1 << 20) - 1, 0x9E3779B97F4A7C15 >> 24
CACHE_WORDS = 100_000
CACHE_BYTES, ENTRY_BYTES = 1 << 25, 200
MERGE_WORDS = 4096
GROUP_CHARS = 1 << 20
#: White space, as the splitter sees it.
_SPACE = " \t\n\v\f\r\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


def _require(spec: dict, path: str) -> None:
    """This module is written for one kind of file; another would give other ids."""
    def items(part, key):
        return [{k: v for k, v in p.items()} for p in (part or {}).get(key, [part] if part else [])]

    normal = [n["type"] for n in items(spec.get("normalizer"), "normalizers")]
    split = items(spec.get("pre_tokenizer"), "pretokenizers")
    model = spec["model"]
    fits = (model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
            and normal == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"].get("Regex") == SPLITTER and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
            and spec.get("decoder") is None and spec.get("post_processor") is None
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not fits:
        raise ValueError(f"{path}: not a lower-casing word BPE file of the kind this encoder reads")


class Vocabulary:
    """Merge list, ids and special tokens of a word BPE file (read once per task)."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        _require(spec, path)
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names: list[str] = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for table in (self.ids, self.special):
            for s, i in table.items():
                self.names[i] = s
        self.numbers = [str(i) for i in range(len(self.names))]
        self.letters = byte_alphabet()
        self.byte_of = {c: b for b, c in self.letters.items()}
        self.texts = [self._text(name) for name in self.names]          # bytes of every id, word end as a space
        self.lookahead = sufficient_lookahead(merges)
        self._pair_table(merges)
        self.split_special = regex.compile("(" + "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) + ")") \
            if self.special else None

    def _text(self, name: str) -> bytes:
        if name in self.special:
            return name.encode()
        ends = bool(self.suffix) and name.endswith(self.suffix)
        return bytes(self.byte_of[c] for c in (name[:-len(self.suffix)] if ends else name)) + (b" " if ends else b"")

    def merge(self, symbols: list[str]) -> list[str]:
        """Apply the merge list: lowest rank first, leftmost among equals."""
        rank, none = self.rank.get, 1 << 30
        ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while 0 < len(ranks) < 256:
            best = min(ranks)
            if best == none:
                return symbols
            i = ranks.index(best)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
        while len(symbols) > 1:                # long: all places of the best rule in one pass
            best = min(rank(p, none) for p in zip(symbols, symbols[1:]))
            if best == none:
                break
            out, i, n = [], 0, len(symbols)
            while i < n:
                if i + 1 < n and rank((symbols[i], symbols[i + 1])) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _pair_table(self, merges: list[tuple[str, str]]) -> None:
        """The merge list as arrays: pair of ids -> rank by open addressing."""
        ids = self.ids
        self.first = np.array([ids[self.letters[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([ids[self.letters[b] + self.suffix] for b in range(256)], dtype=np.int64)
        self.made = np.array([ids[u + v] for u, v in merges], dtype=np.int64)
        self.pairs = np.full(1 << 20, -1, dtype=np.int64)
        self.pair_rank = np.full(1 << 20, _NONE, dtype=np.int32)
        for rank, (u, v) in enumerate(merges):
            key = ids[u] << 24 | ids[v]
            at = (key * _SPREAD >> 20) & _SLOTS
            while self.pairs[at] >= 0:
                at = (at + 1) & _SLOTS
            self.pairs[at], self.pair_rank[at] = key, rank

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 24 | right
        with np.errstate(over="ignore"):
            at = (key.astype(np.uint64) * np.uint64(_SPREAD) >> np.uint64(20)).astype(np.int64) & _SLOTS
        out = np.full(key.shape, _NONE, dtype=np.int32)
        open_ = np.flatnonzero(left.ravel() >= 0) if left.size and left.min() < 0 else np.arange(key.size)
        open_ = open_[right.ravel()[open_] >= 0]
        key, at, flat = key.ravel(), at.ravel(), out.ravel()
        while open_.size:
            held = self.pairs[at[open_]]
            hit = held == key[open_]
            flat[open_[hit]] = self.pair_rank[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
            at[open_] = (at[open_] + 1) & _SLOTS
        return flat.reshape(left.shape)

    def merge_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short ended words at once, and how many each has; row by row
        the same rule as ``merge``.

        A merged pair leaves its right cell empty; ``after`` and ``before`` name the
        cells in use next to each, so a step touches no more than the pair's neighbours.
        """
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        n, wide = len(raw), int(size.max()) + 2               # an empty cell at either end
        sym = np.full((n, wide), -1, dtype=np.int64)
        here = np.arange(1, wide + 1) <= size[:, None]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym[:, 1:][here[:, :-1]] = self.first[data]
        sym[np.arange(n), size] = self.last[data[np.cumsum(size) - 1]]
        rank = np.full((n, wide), _NONE, dtype=np.int32)
        rank[:, :-1] = self.ranks(sym[:, :-1], sym[:, 1:])
        flat, base = sym.ravel(), np.arange(n) * wide
        after = np.arange(1, n * wide + 1)
        before = after - 2
        while base.size:
            at = rank.argmin(axis=1)
            best = rank[np.arange(base.size), at]
            if best.max() == _NONE:
                go = np.flatnonzero(best != _NONE)
                base, rank, at, best = base[go], rank[go], at[go], best[go]
                if not base.size:
                    break
            each = np.arange(base.size)
            left = base + at
            right = after[left]
            beyond, prior = after[right], before[left]
            flat[left], flat[right] = self.made[best], -1
            after[left], before[beyond] = beyond, left
            rank[each, right - base] = _NONE
            new = self.ranks(flat[np.concatenate([prior, left])], flat[np.concatenate([left, beyond])])
            rank[each, prior - base], rank[each, at] = new[:base.size], new[base.size:]
        used = sym >= 0
        return sym[used], used.sum(axis=1)

    def symbols(self, word: str, ended: bool = True) -> list[str]:
        letters = self.letters
        out = [letters[b] for b in word.encode("utf-8")]
        if ended and out:
            out[-1] += self.suffix
        return out


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols beyond a token's end settle it, for this merge list.

    ``reach[u]``: longest chain so far that ends with a rule whose left part is
    ``u``.  A rule (u, v) prolongs a chain that stopped before ``w`` when ``w``
    stands on the left edge of ``v``, i.e. ``v`` can have grown out of ``w``.
    Requires that a rule's parts are made by rules of lower rank (checked).
    """
    made = {u + v: i for i, (u, v) in enumerate(merges)}
    left = {u + v: u for u, v in merges}
    reach: dict[str, int] = {}
    most = 0
    for i, (u, v) in enumerate(merges):
        if any(made.get(p, -1) >= i for p in (u, v)):
            raise ValueError(f"merge {i} uses a part that is made later")
        longest, w = 0, v
        while w is not None:
            longest = max(longest, reach.get(w, 0))
            w = left.get(w)
        own = longest + len(u)
        reach[u] = max(reach.get(u, 0), own)
        most = max(most, own)
    return most


# ------------------------------------------------------------- encoding
#: Fixed values of the tokenizer file: what a word is, after lower-casing; its splitter's own text.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+"
_WORD = regex.compile(WORDS)
_LETTERS = regex.compile(r"\p{L}+")
_SIGNS = regex.compile(r"[^" + _SPACE + r"\p{L}\p{N}]+")
_ANY_SPACE = regex.compile("[" + _SPACE + "]")
_SPACES = regex.compile("[" + _SPACE + "]+")
_WIDE_SPACE = [c for c in _SPACE if not c.isascii()]
_OTHER_SPACE = "\x1c\x1d\x1e\x1f"                 # spaces to str.split only
_PLAIN = re.compile("([a-zß-öø-ɏ]+)([.,;:!?]*)").fullmatch      # a word and its signs, all that most pieces are


def normalise(text: str) -> str:
    """NFC, then lower case letter by letter (a final sigma is not special)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace(chr(0x3A3), chr(0x3C3))
    return text.lower()


def _safe_cut(text: str, at: int) -> int:
    """Largest place <= ``at`` where normalising both sides apart changes nothing:
    before a character that never joins what stands before it."""
    while at > 0:
        c = ord(text[at])
        if c < 0x300 or 0x3400 <= c <= 0x9FFF or 0xAC00 <= c <= 0xD7A3:
            return at
        at -= 1
    return 0


class Encoder:
    """``feed`` text in pieces, ``close`` at the end; both give lists of ids.

    ``cache`` maps what stands between spaces, and single words, to their ids;
    it is emptied when it holds ``cache_words`` entries.
    """

    def __init__(self, vocab: Vocabulary, cache: dict[str, tuple[int, ...]] | None = None,
                 cache_words: int = CACHE_WORDS, chunk: int = CHUNK):
        self.v, self.cache, self.cache_words = vocab, {} if cache is None else cache, cache_words
        self.hold = max(chunk, 2 * vocab.lookahead + 2)
        self.raw, self.text, self.open = "", "", None       # open: pattern of a word that goes on
        self.head: list[str] = []                           # its symbols before ``text``: the end of a character

    def _keep(self, text: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(text) <= 64:
            if len(self.cache) >= self.cache_words:
                self.cache.clear()
            self.cache[text] = ids
        return ids

    def _word(self, word: str) -> tuple[int, ...]:
        if (ids := self.cache.get(word)) is None:
            v = self.v
            if len(word) > 4096:
                return tuple(self._long(word))
            ids = self._keep(word, tuple([v.ids[s] for s in v.merge(v.symbols(word))]))
        return ids

    def _between_spaces(self, piece: str) -> tuple[int, ...]:
        return self._keep(piece, tuple(chain.from_iterable(map(self._word, _WORD.findall(piece)))))

    def _whole(self, text: str, out: list[int]) -> None:
        """Encode a text that ends with a word's end."""
        pieces = _SPACES.split(text) if any(c in text for c in _OTHER_SPACE) else text.split()
        found = list(map(self.cache.get, pieces))
        if None in found:
            found = [self._between_spaces(p) if f is None else f for p, f in zip(pieces, found)]
        out.extend(chain.from_iterable(found))

    def _long(self, word: str, head: list[str] | None = None) -> list[int]:
        """A word of any length in pieces, each emitted once stable.

        ``head``: symbols that stand before it, left of a character that was cut.
        """
        out, head = [], head or []
        while len(word) > self.hold:
            ids, head, word = self._stable(head, word)
            out.extend(ids)
        symbols = head + self.v.symbols(word, ended=False)
        if symbols:
            symbols[-1] += self.v.suffix
        out.extend(self.v.ids[s] for s in self.v.merge(symbols))
        return out

    def _stable(self, head: list[str], word: str) -> tuple[list[int], list[str], str]:
        """Ids of the part of an unfinished word that no continuation changes,
        and what is left of it: symbols of a cut character, then whole ones."""
        v = self.v
        part = word[:self.hold]
        tokens = v.merge(head + v.symbols(part, ended=False))      # a symbol is one byte and one letter
        left = sum(map(len, tokens))
        count = cut = 0
        for count, t in enumerate(tokens):                          # hold is above twice the lookahead
            if left - len(t) < v.lookahead:
                break
            left -= len(t)
            cut += len(t)
        else:
            count = len(tokens)
        ids = [v.ids[s] for s in tokens[:count]]
        if cut <= len(head):
            return ids, head[cut:], word
        data = part.encode("utf-8")
        at = cut = cut - len(head)
        while at < len(data) and data[at] & 0xC0 == 0x80:           # to the next character's first byte
            at += 1
        rest = data[at:].decode("utf-8")
        return ids, [v.letters[x] for x in data[cut:at]], rest + word[self.hold:]

    def feed(self, raw: str, last: bool = False) -> list[int]:
        out: list[int] = []
        raw = self.raw + raw
        if self.v.split_special is not None:
            # special strings are cut out of the text as it stands
            parts = self.v.split_special.split(raw)
            for k in range(0, len(parts) - 1, 2):
                out += self._pieces(normalise(parts[k]), True)
                out.append(self.v.special[parts[k + 1]])
            raw = parts[-1]
        cut = len(raw)
        if not last:                 # the end may be part of a special string or of a composed letter
            longest = max(map(len, self.v.special), default=1) - 1
            cut = _safe_cut(raw, len(raw) - 1 - longest) if len(raw) >= self.hold else 0
        self.raw = raw[cut:]
        out += self._pieces(normalise(raw[:cut]), last)
        return out

    def close(self) -> list[int]:
        return self.feed("", last=True)

    def _pieces(self, text: str, ended: bool) -> list[int]:
        """Encode normalised text; unless ``ended`` its last word may go on."""
        out: list[int] = []
        self.text += text
        if self.open is not None:
            m = self.open.match(self.text)
            end = m.end() if m else 0
            if end == len(self.text) and not ended:
                return self._grow(out)
            out.extend(self._long(self.text[:end], self.head))
            self.text, self.open, self.head = self.text[end:], None, []
        if ended:
            self._whole(self.text, out)
            self.text = ""
            return out
        at = 0
        for space in _ANY_SPACE.finditer(self.text, pos=max(0, len(self.text) - 4096)):
            at = space.end()
        if not at:
            for space in _ANY_SPACE.finditer(self.text):
                at = space.end()
        self._whole(self.text[:at], out)
        self.text = self.text[at:]
        if len(self.text) > 2 * self.hold:       # no space for long: all but the last words are whole
            words = _WORD.findall(self.text)
            tail = [words.pop()]
            if words and words[-1] == "'" and len(tail[0]) < 2:
                tail.insert(0, words.pop())      # may become one of the endings, as 're
            for w in words:
                out.extend(self._word(w))
            self.text = "".join(tail)
            if len(tail) == 1 and tail[0] != "'":
                self.open = next((p for p in (_LETTERS, _SIGNS) if p.fullmatch(tail[0])), None)
                if self.open is None:            # a digit or an ending: whole
                    out.extend(self._word(tail[0]))
                    self.text = ""
                return self._grow(out)
        return out

    def _grow(self, out: list[int]) -> list[int]:
        while len(self.text) > 2 * self.hold:
            ids, self.head, self.text = self._stable(self.head, self.text)
            out.extend(ids)
        return out


class Rows:
    """Number lists of various lengths, one after the other."""

    def __init__(self):
        self.ends, self.values = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.values = np.concatenate([self.values, values.astype(np.int32)])

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values, joined, and where each row ends in them."""
        start, size = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if ends.size else 0
        return self.values[np.repeat(start - ends + size, size) + np.arange(total)], ends


class Pieces:
    """Ids of whole short texts, many at once: each piece between spaces is encoded
    when it is first met and looked up from then on.

    A text of less than a chunk without special strings is what ``Encoder`` encodes
    in one step, so its ids are those of its pieces.  New words of many texts are
    merged together.  Everything learned goes when it exceeds ``CACHE_BYTES``.
    """

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.numbers, self.names = pa.array(vocab.numbers), pa.array(vocab.names)
        self.texts = pa.array(vocab.texts, pa.binary())
        self._forget()

    def _forget(self) -> None:
        self.words, self.pieces, self.size = {}, {"": 0}, 0
        self.word_ids, self.piece_ids = Rows(), Rows()
        self.piece_ids.add(np.zeros(0), np.zeros(1, dtype=np.int64))

    def fits(self, text: str) -> bool:
        return len(text) < CHUNK and not any(s in text for s in self.v.special)

    def _learn(self, new: list[str]) -> None:
        parts = [((m[1], m[2]) if m[2] else (m[1],)) if (m := _PLAIN(p)) else _WORD.findall(p) for p in new]
        fresh = sorted({w for ws in parts for w in ws if w not in self.words}, key=len)
        short = bisect_right(fresh, 64, key=len)
        for at in range(0, short, MERGE_WORDS):
            self.word_ids.add(*self.v.merge_many(fresh[at:min(short, at + MERGE_WORDS)]))
        alone = Encoder(self.v)
        for w in fresh[short:]:
            ids = np.array(alone._word(w))
            self.word_ids.add(ids, np.array([ids.size]))
        self.words.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh))))
        rows = np.fromiter(map(self.words.__getitem__, chain.from_iterable(parts)), dtype=np.int64)
        ids, ends = self.word_ids.get(rows)
        last = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64))
        self.piece_ids.add(ids, np.diff(ends[last - 1], prepend=0))
        self.pieces.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new))))
        self.size += sum(map(len, new)) + sum(map(len, fresh)) + ENTRY_BYTES * (len(new) + len(fresh))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and where each text's begin (and the last one's end)."""
        if self.size > CACHE_BYTES:
            self._forget()
        split = pc.ascii_split_whitespace(pa.array(map(_plain_spaces, map(normalise, texts)), pa.large_string()))
        found = split.values.dictionary_encode()
        each = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in each if p not in self.pieces]
        if new:
            self._learn(new)
        rows = np.fromiter(map(self.pieces.__getitem__, each), dtype=np.int64, count=len(each))
        ids, ends = self.piece_ids.get(rows[found.indices.to_numpy()])
        return ids, np.concatenate([[0], ends])[split.offsets.to_numpy()]

    def joined(self, table: pa.Array, ids: np.ndarray, at: np.ndarray, by: str) -> list[pa.Buffer]:
        """Per text what its ids stand for in ``table``, joined."""
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), table.take(pa.array(ids)))
        return [x.as_buffer() for x in pc.binary_join(lists, by if pa.types.is_string(table.type) else by.encode())]


def _plain_spaces(text: str) -> str:
    """White space beyond ASCII as plain spaces."""
    return text if text.isascii() or not any(c in text for c in _WIDE_SPACE) else _SPACES.sub(" ", text)


def encode(vocab: Vocabulary, text: str | None, cache=None, chunk: int = CHUNK) -> Iterator[list[int]]:
    """Ids of ``text`` in pieces (null: none)."""
    text = text or ""
    enc = Encoder(vocab, cache, chunk=chunk)
    for at in range(0, len(text), chunk):
        yield enc.feed(text[at:at + chunk])
    yield enc.close()


# ------------------------------------------------------------- decoding
class Decoder:
    """Ids to the library's text for files without a decoder: names joined by spaces."""

    def __init__(self, vocab: Vocabulary):
        self.names, self.begun = vocab.names, False

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        text = " ".join(map(self.names.__getitem__, ids))
        text, self.begun = " " + text if self.begun else text, True
        return text


class TextDecoder:
    """Ids to readable text: bytes are collected until a character is complete
    (broken sequences give U+FFFD), a word end gives one space."""

    def __init__(self, vocab: Vocabulary):
        self.bytes, self.state = vocab.texts, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)), last)


# ------------------------------------------------------------- on tables
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
             with_ids: bool = False, readable: bool = False) -> DataFrame:
    """Row per input row: id, n_tokens, ids_sha256, decoded_sha256, for the
    tokenizer file at ``path`` on every executor; ``ids`` with ``with_ids``, and with
    ``readable`` ``readable_sha256``, of what ``TextDecoder`` makes of the ids.

    Null texts count as empty (no tokens, digests of nothing); ids may be null
    and may repeat.  Chunk by chunk, so only digests and counts grow with a text.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    fields = rows.schema[id_col].dataType.simpleString()

    def streamed(vocab, cache, text):
        """n, digests of ids and text, packed ids, digest of the readable text, chunk by chunk."""
        n, first, a, d, x, own = 0, True, hashlib.sha256(), hashlib.sha256(), hashlib.sha256(), array("i")
        dec, plain = Decoder(vocab), TextDecoder(vocab)
        for ids in encode(vocab, text, cache):
            if ids:
                s = " ".join(map(vocab.numbers.__getitem__, ids))
                a.update((s if first else " " + s).encode())
                d.update(dec.feed(ids).encode())
                n, first = n + len(ids), False
                if with_ids:
                    own.extend(ids)
                if readable:
                    x.update(plain.feed(ids).encode())
        x.update(plain.feed([], last=True).encode())
        return n, a.hexdigest(), d.hexdigest(), own.tobytes(), x.hexdigest()

    def at_once(pieces, texts):
        """The same of each of some short texts."""
        ids, at = pieces.encode(texts)
        numbers, names = (pieces.joined(t, ids, at, " ") for t in (pieces.numbers, pieces.names))
        plain = pieces.joined(pieces.texts, ids, at, "") if readable else [b""] * len(texts)
        for k, (a, b, c) in enumerate(zip(numbers, names, plain)):
            own = ids[at[k]:at[k + 1]].tobytes() if with_ids else b""
            yield (int(at[k + 1] - at[k]), hashlib.sha256(a).hexdigest(), hashlib.sha256(b).hexdigest(), own,
                   hashlib.sha256(str(c, "utf-8", "replace").encode()).hexdigest())

    def groups(texts):
        """Some rows at a time, by a bounded amount of text: first row, texts."""
        at, some, size = 0, [], 0
        for k in range(len(texts)):
            some.append(texts[k].as_py() or "")
            size += len(some[-1])
            if size >= GROUP_CHARS:
                yield at, some
                at, some, size = k + 1, [], 0
        if some:
            yield at, some

    def run(batches):
        vocab = Vocabulary(path)
        pieces, cache = Pieces(vocab), {}
        for b in batches:
            for at, some in groups(b.column(1)):
                short = list(map(pieces.fits, some))
                found = at_once(pieces, [t for t, s in zip(some, short) if s])
                count, ids_sha, text_sha, own, read = zip(*[
                    next(found) if s else streamed(vocab, cache, t) for t, s in zip(some, short)])
                cols = [b.column(0).slice(at, len(some)), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()),
                        pa.array(text_sha, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ends = pa.array(np.cumsum([0, *count]), pa.int32())
                    cols.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(own), dtype=np.int32))))
                    names.append("ids")
                if readable:
                    cols.append(pa.array(read, pa.string()))
                    names.append("readable_sha256")
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, f"`{id_col}` {fields}, {SCHEMA}" + (", ids array<int>" if with_ids else "")
                           + (", readable_sha256 string" if readable else ""))
