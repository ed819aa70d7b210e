"""Operator 6: BPE encoding and decoding by batched numpy merge rounds.

The vocabulary file of a lower-case word-level BPE tokenizer is read on the driver and broadcast (its size is
fixed). White space separates independent pieces, so each distinct piece of a batch is encoded once: it is
normalised, cut into words, and the symbols of all new words lie in one flat array. A round finds every
adjacent pair's rank by binary search over the sorted pair keys and merges, in each word, all occurrences of
its lowest-ranked pair; words without a known pair leave. Rounds are few because all words advance together.

Defined cases: a NULL text is empty and has no tokens; the special tokens' strings inside a text become their
ids, as in the tokenizers library; very long unbroken words take as many rounds as their merge depth; rows are
independent, so repeated rows, ties and other columns change nothing.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, normalizers

from .common import id_text, share

#: Pieces whose encoding one Python worker keeps between batches; beyond it the memory is emptied.
CACHE_PIECES = 250_000
#: A word is at most one run of letters, one digit or one run of other signs (the tokenizer file's own pattern).
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")
#: Planes that hold signs of any class; all others are unassigned or for private use in every Unicode version.
PLANES = ((0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000))
#: A sign of each class, none of which takes part in the word pattern by itself.
LETTER, NUMBER, OTHER = "ª", "²", "§"
MARK = chr(0x0334)  # a combining mark of the first class: marks of later classes change places with it


class Signs:
    """Where the tokenizers library's Unicode tables differ from Python's, found on the driver by asking the library
    about every code point: ``lower`` (sign to its lower-case form), ``like`` (sign to one of the same class) and
    ``fixed`` (signs that its composition neither moves nor joins to others, whatever Python's tables say)."""

    def __init__(self, path: str, word: regex.Pattern):
        whole = Tokenizer.from_file(path)
        nfc, low = normalizers.NFC(), normalizers.Lowercase()
        self.lower: dict[int, str] = {}
        self.like: dict[int, str] = {}
        still, joins = set(), set()
        for lo, hi in PLANES:
            for at in range(lo, hi, 4096):
                self._ask([chr(c) for c in range(at, min(hi, at + 4096))], whole, word, nfc, low, still, joins)
        self.fixed = "".join(sorted(still - joins))
        known = {*self.fixed, *map(chr, self.lower), *map(chr, self.like)}
        #: A text without any of these is treated alike by both tables.
        self.odd = frozenset(known | {c.upper() for c in known} | {unicodedata.normalize("NFD", c)[-1] for c in known})

    def _ask(self, chars: list[str], whole: Tokenizer, word: regex.Pattern, nfc, low, still: set[str], joins: set[str]) -> None:
        for c in chars:
            small = low.normalize_str(c)
            if small != c.lower() and c != "Σ":
                self.lower[ord(c)] = small
            moved = "a" + c + MARK
            if unicodedata.normalize("NFC", moved) != moved == nfc.normalize_str(moved):
                still.add(c)
            apart = unicodedata.normalize("NFD", c)
            if len(apart) > 1 and unicodedata.normalize("NFC", apart) == c:
                (joins if nfc.normalize_str(apart) == c else still).add(apart[-1])
        # "a" joins letters, "!" joins other signs, numbers stand alone, white space is in no word
        text, step = "".join([f"a{c} !{c} " for c in chars]), 6
        theirs = {span for _, span in whole.pre_tokenizer.pre_tokenize_str(text)}
        ours = {m.span() for m in word.finditer(text)}
        for i, c in enumerate(chars):
            both, other, alone = (i * step, i * step + 2), (i * step + 3, i * step + 5), (i * step + 1, i * step + 2)
            if any((x in theirs) != (x in ours) for x in (both, other, alone)):
                self.like[ord(c)] = LETTER if both in theirs else OTHER if other in theirs else NUMBER if alone in theirs else " "


class WordBpe:
    """Encoder and decoder of one vocabulary. ``spec`` is the parsed tokenizer file; ``path`` is the same file, which
    the tokenizers library reads for its Unicode tables."""

    def __init__(self, spec: dict, path: str):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"]
        self.tokens = [""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = token
        self.size = len(self.tokens)
        self.added = added
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(split)
        self.signs = Signs(path, self.word)
        self.fixed = regex.compile(f"([{regex.escape(self.signs.fixed)}]+)") if self.signs.fixed else None
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.last = np.array([vocab[c + self.end] for c in chars], dtype=np.int64)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs], dtype=np.int64)
        b = np.array([vocab[y] for _, y in pairs], dtype=np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], dtype=np.int64)
        keys = a * self.size + b
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]
        self.cache: dict[str, tuple[bytes, str]] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def _ranks(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each symbol's pair with its right neighbour (none: a huge value), and its key's place."""
        key = sym[:-1] * self.size + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (word[:-1] == word[1:])
        rank = np.full(len(sym), np.iinfo(np.int64).max)
        place = np.zeros(len(sym), dtype=np.int64)
        rank[:-1][ok], place[:-1][ok] = self.rank[at[ok]], at[ok]
        return rank, place

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of many non-empty words, one after another, and where each word's ids end."""
        length = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(length) - 1
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank, place = self._ranks(sym, word)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(sym)]]))
            least = np.minimum.reduceat(rank, starts)
            over = least == np.iinfo(np.int64).max
            stay = ~np.repeat(over, sizes)
            done.append((word[~stay], sym[~stay]))
            if not stay.any():
                break
            hit = np.flatnonzero((rank == np.repeat(least, sizes)) & stay)
            # in a run of overlapping hits (a pair of equal symbols) every second one is taken, from the left
            new_run = np.concatenate([[True], np.diff(hit) != 1])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            sym = sym.copy()
            sym[hit] = self.made[place[hit]]
            stay[hit + 1] = False
            sym, word = sym[stay], word[stay]
        word, sym = (np.concatenate(x) for x in zip(*done))
        return sym[np.argsort(word, kind="stable")], np.cumsum(np.bincount(word, minlength=len(words)))

    def words(self, piece: str, plain: bool = False) -> list[str]:
        """Words of a piece, composed and in lower case by the library's tables; ``plain``: it has no odd sign."""
        if plain or self.signs.odd.isdisjoint(piece):
            return self.word.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())
        parts = self.fixed.split(piece) if self.fixed is not None else [piece]
        piece = "".join([x if i % 2 else unicodedata.normalize("NFC", x) for i, x in enumerate(parts)])
        piece = piece.replace("Σ", "σ").lower().translate(self.signs.lower)
        # signs that the library puts in another class are matched by a stand-in
        return [piece[m.start() : m.end()] for m in self.word.finditer(piece.translate(self.signs.like))]

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces (no white space in them) into the cache."""
        cut, words = {}, {}
        plain = self.signs.odd.isdisjoint("".join(pieces))
        for p in pieces:
            cut[p] = [w.encode() for w in self.words(p, plain)]
            for w in cut[p]:
                words.setdefault(w, len(words))
        ids, ends = self.merge(list(words)) if words else (np.empty(0, np.int64),) * 2
        raw, said = ids.astype("<u4").tobytes(), list(map(self.tokens.__getitem__, ids.tolist()))
        places = [0, *ends.tolist()]
        got = [(raw[4 * lo : 4 * hi], said[lo] if hi - lo == 1 else " ".join(said[lo:hi])) for lo, hi in zip(places, places[1:])]
        for p, ws in cut.items():
            if len(ws) == 1:
                self.cache[p] = got[words[ws[0]]]
            else:
                parts = [got[words[w]] for w in ws]
                self.cache[p] = (b"".join([x for x, _ in parts]), " ".join([x for _, x in parts]))

    def pieces(self, text: str) -> list[str]:
        """White-space separated pieces; a special token's string is a piece of its own."""
        if self.special is not None and "<|" in text:
            parts = self.special.split(text)
        else:
            parts = [text]
        out: list[str] = []
        for part in parts:
            if part in self.added:
                out.append(part)
            elif ODD_SPACE.search(part):  # str.split() would also cut at these four
                out += [x for x in SPACE.split(part) if x]
            else:
                out += part.split()
        return out

    def encode_batch(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """Per text: its ids as little-endian 32-bit integers, and its decoded text. The garbage collector rests
        meanwhile: it would go over the whole cache again and again, which holds no cycles."""
        running = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if running:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        out = []
        if len(self.cache) > CACHE_PIECES:
            self.cache = {}
        for t in self.added:
            self.cache.setdefault(t, (np.array([self.added[t]], "<u4").tobytes(), t))
        cut = [self.pieces(text or "") for text in texts]
        new = set().union(*cut).difference(self.cache)
        if new:
            self._learn(new)
        for pieces in cut:
            got = list(map(self.cache.__getitem__, pieces))
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])))
        return out

    def decode(self, ids) -> str:
        return " ".join([self.tokens[int(i)] for i in ids])


def byte_chars() -> list[str]:
    """The printable stand-in of every byte value in a byte-level vocabulary: printable Latin-1 signs stand
    for themselves, the others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f), path)


def _texts(batch: pa.RecordBatch, col: str, size: int = 256) -> Iterator[tuple[int, list]]:
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        yield at, part.column(part.schema.get_field_index(col)).to_pylist()


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` (long), ``ids_sha256``, ``decoded_sha256``; with ``with_ids`` also ``ids``
    (array of int) and ``decoded`` (string). ``path`` is the vocabulary file, read on the driver only."""
    shared = share(docs.sparkSession, load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared()
        for batch in batches:
            ids = batch.column(0)
            for at, texts in _texts(batch, "text"):
                got = bpe.encode_batch(texts)
                cols = [
                    ids.slice(at, len(texts)),
                    pa.array([len(g[0]) // 4 for g in got], pa.int64()),
                    pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string()),
                    pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array([np.frombuffer(g[0], "<i4") for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return id_text(docs).mapInArrow(run, schema)
