"""Token ids of whole texts with the tokenizers library, each distinct word of a batch asked for once.

Both supported kinds of vocabulary cut a text at white space and between letters and
signs before merging, so a word's ids don't depend on its neighbours. A batch of texts is split into words
by Arrow, its distinct words get their ids from a cache or the library, and the texts' ids are
gathered from these. Each worker keeps the ids of words that it has met more than once.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and signs after words, kept in a worker's caches; a full one starts anew. Some 70 MB.
CACHE_WORDS, CACHE_TAILS = 350_000, 10_000
#: Longer words aren't kept.
CACHE_LETTERS = 64
#: Places for marks of words that came once, a byte each.
MARKS = 1 << 22
#: Bytes of the texts that are split together; a longer text is split alone.
GROUP_BYTES = 4 << 20

_END = struct.pack("<I", 0)
_BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
_SPACE_AFTER_WORD = re.compile(r"(?<=\S)(?= )")
#: A word of Latin-1 letters and the ASCII signs after it.
_CORE = r"^(?P<core>[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
_PROBES = ("ab", "Zebra", "été", "Straße", "ñandú", "Über", "ÉTÉ", "à")
_loaded: dict[str, Encoder] = {}


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the UTF-8 bytes of Latin-1 letters beyond ASCII.

    Fixed rule of the format: bytes that print in Latin-1 stand for themselves, the others are numbered from U+0100 on.
    """
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = (b for b in range(256) if b not in prints)
    letter = {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


class Words:
    """Ids of words as bytes. ``lead`` is the blank before each word, or nothing.

    A word is kept if it comes often in a batch, or from its second batch on, so the many words that come once take
    no room. That it came before is told by a mark at its hash; a wrong mark only keeps a word early. A full
    cache becomes the old one, whose words move to the new one when they come again.
    """

    def __init__(self, lead: str):
        self.lead, self.new, self.old, self.met = lead, {}, {}, bytearray(MARKS)

    def look(self, words: list[str], often: np.ndarray, find: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of each of some distinct words; ``find`` gives those of words that aren't kept."""
        out = list(map(self.new.get, words))
        unknown = []
        for i in [i for i, x in enumerate(out) if x is None]:
            ids = self.old.get(words[i])
            if ids is None:
                unknown.append(i)
            else:
                out[i] = ids
                self._keep(words[i], ids)
        met, often = self.met, often.tolist()
        for i, ids in zip(unknown, find([words[i] for i in unknown]), strict=True):
            out[i] = ids
            word = words[i]
            at = hash(word) % MARKS
            if often[i] or met[at]:
                if len(word) <= CACHE_LETTERS:
                    self._keep(word, ids)
            else:
                met[at] = 1
        return out

    def _keep(self, word: str, ids: bytes) -> None:
        if len(self.new) >= CACHE_WORDS // 2:
            self.old, self.new, self.met[:] = self.new, {}, bytes(MARKS)
        self.new[word] = ids


class Encoder:
    """``encode`` gives the ids of a batch of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.tokenize = self.inner.model.tokenize
        self.bare, self.spaced = Words(""), Words(" ")
        self.tails: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.packed = [struct.pack("<I", i) for i in range(self.inner.get_vocab_size())]
        self.line = self.plain("\n")
        self.kind = self._kind()
        self.lowers = self.plain("AbÉ") == self.plain("abé")
        self.direct = self.kind != "unknown" and all(
            self.merged([p.lower() if self.lowers else p], lead) == [self.plain(lead + p)] and self.plain(f"{lead}{p},;") == self.plain(lead + p) + self.plain(",;")
            for p in _PROBES for lead in (("", " ") if self.kind == "kept" else ("",))
        )

    def _kind(self) -> str:
        """How this tokenizer treats a blank between two words: dropped, kept before the next word, or unknown."""
        ids = self.plain
        a, b = ids("ab"), ids("cd")
        if ids("ab cd") == ids("ab\ncd") == ids("ab \n  cd") == a + b:
            return "dropped"
        if ids("ab cd") == a + ids(" cd") and ids("ab\n cd") == a + ids("\n") + ids(" cd") and ids("ab\ncd") == a + ids("\n") + b:
            return "kept"
        return "unknown"

    def plain(self, text: str) -> bytes:
        return _pack(self.inner.encode(text, add_special_tokens=False).ids)

    def merged(self, cores: list[str], lead: str) -> list[bytes]:
        """The library's merges of words of Latin-1 letters, written as the vocabulary writes bytes."""
        before, letters, packed = "Ġ" if lead else "", self.letters, self.packed
        written = [before + (c if c.isascii() else c.translate(letters)) for c in cores]
        return [b"".join([packed[t.id] for t in found]) for found in map(self.tokenize, written)]

    def tail(self, signs: str) -> bytes:
        found = self.tails.get(signs)
        if found is None:
            if len(self.tails) >= CACHE_TAILS:
                self.tails.clear()
            self.tails[signs] = found = self.plain(signs)
        return found

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time, in order: all their ids (unsigned 32-bit), each text's followed by id 0, and the places where texts begin, with the end."""
        group = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield self._group(pc.fill_null(texts.slice(a, b - a).cast(pa.large_string()), ""))
        pa.default_memory_pool().release_unused()

    def _ids(self, words: pa.Array, times: np.ndarray, known: Words) -> pa.Array:
        """The ids of each distinct word, which came ``times`` times, after the blank of ``known``."""
        if not self.direct:
            return self._table(words, times, known, lambda w: [self.plain(known.lead + x) for x in w])
        parts = pc.extract_regex(words, pattern=_CORE)
        core, tail = parts.field(0), parts.field(1)
        coded = (pc.utf8_lower(core) if self.lowers else core).dictionary_encode()
        tails = tail.dictionary_encode()
        other = parts.is_null()
        plain = pc.filter(words, other)
        at = coded.indices.fill_null(len(coded.dictionary)).to_numpy()
        often = np.bincount(at, times, len(coded.dictionary))[: len(coded.dictionary)]
        letters = self._table(coded.dictionary, often, known, lambda c: self.merged(c, known.lead))
        signs = pa.array([self.tail(x) for x in tails.dictionary.to_pylist()], pa.large_binary())
        whole = pc.binary_join_element_wise(letters.take(coded.indices), signs.take(tails.indices), pa.scalar(b"", pa.large_binary()))
        rest = self._table(plain, times[other.to_numpy(zero_copy_only=False)], known, lambda w: [self.plain(known.lead + x) for x in w])
        return pc.replace_with_mask(whole, other, rest)

    def _table(self, words: pa.Array, times: np.ndarray, known: Words, find: Callable[[list[str]], list[bytes]]) -> pa.Array:
        return pa.array(known.look(words.to_numpy(zero_copy_only=False).tolist(), times > 1, find), pa.large_binary())

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known, whole = self.bare, np.zeros(len(texts), bool)
        if self.kind == "dropped":
            cut = pc.replace_substring(texts, "\n", " ")
        else:  # two blanks in a row have rules of their own
            known = self.spaced
            whole = pc.match_substring_regex(texts, _BLANK + _BLANK).to_numpy(zero_copy_only=False) | (self.kind == "unknown")
            cut = pc.replace_substring(pc.if_else(pa.array(whole), "", texts), "\n", " \n ")
        alone = np.flatnonzero(whole)
        split = pc.split_pattern(cut, " ")
        starts = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy().copy()
        tables = [self._whole(texts.take(pa.array(alone)).to_pylist()), [_END, self.line]]
        bare = pa.array([], pa.large_binary())
        first_own = len(distinct)
        if known is self.spaced:  # a line's first word has no blank before it
            line = pc.index(distinct, pa.scalar("\n", distinct.type)).as_py()
            breaks = np.flatnonzero(codes == line) if line >= 0 else np.zeros(0, np.int64)
            at = np.concatenate([starts[:-1], breaks + 1])
            firsts, places, times = np.unique(codes[at], return_inverse=True, return_counts=True)
            bare = self._ids(distinct.take(pa.array(firsts)), times, self.bare)
            codes[at] = len(distinct) + places
            first_own += len(firsts)
            codes[breaks] = first_own + len(alone) + 1
            codes[starts[:-1][alone]] = first_own + np.arange(len(alone))
        times = np.bincount(codes, minlength=len(distinct))[: len(distinct)]
        asked = np.flatnonzero(times)
        place = np.cumsum(times > 0) - 1  # of a word among those asked for
        found = self._ids(distinct.take(pa.array(asked)), times[asked], known)
        codes = np.where(codes < len(distinct), place[np.minimum(codes, len(distinct) - 1)], codes - len(distinct) + len(asked))
        table = pa.concat_arrays([found, bare, pa.array(tables[0] + tables[1], pa.large_binary())])
        codes = np.insert(codes, starts[1:], len(table) - 2)
        ids = table.take(pa.array(codes))
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64)[ids.offset :][starts + np.arange(len(starts))] // 4
        return np.frombuffer(data, "<u4"), at

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The ids of texts with two blanks in a row, which are cut only at spaces after a word."""
        if self.kind == "unknown":
            return [self.plain(t) for t in texts]
        if not texts:
            return []
        cut = [_SPACE_AFTER_WORD.split(t) for t in texts]
        coded = pa.array([x for c in cut for x in c], pa.large_string()).dictionary_encode()
        table, spaced = [b""] * len(coded.dictionary), []
        for i, x in enumerate(coded.dictionary.to_pylist()):
            if x[:1] == " " and len(x.split()) == 1 and x[1:] == x.strip():
                spaced.append(i)
            else:
                table[i] = self.plain(x)
        times = np.bincount(coded.indices.to_numpy(), minlength=len(table))
        words = pc.utf8_slice_codeunits(coded.dictionary.take(pa.array(spaced, pa.int64())), 1)
        for i, ids in zip(spaced, self._ids(words, times[spaced], self.spaced).to_pylist(), strict=True):
            table[i] = ids
        codes = iter(coded.indices.to_numpy().tolist())
        return [b"".join([table[next(codes)] for _ in c]) for c in cut]


def encoder(path: str) -> Encoder:
    """One encoder for each file in a worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encoded(path: str, texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's ids, with id 0 at the end; null counts as empty."""
    for ids, at in encoder(path).encode(texts):
        bounds = at.tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[a:b]
