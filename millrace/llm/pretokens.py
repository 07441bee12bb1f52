"""Split many texts into the words of a public tokenizer at once, and encode each distinct word once.

Two splits are known: ``clip`` (lower case, white space dropped) and ``gpt`` (white space kept, a space
leads its word). Texts of Latin letters without apostrophes or special tokens are split with numpy by
character class. All others are split by the tokenizers library itself.
"""

import codecs
import functools
import itertools
import json
import os
import unicodedata

import numpy as np

from millrace.llm import spans

LATIN = 0x250
LETTER, NUMBER, SPACE, OTHER, HARD = range(5)


@functools.cache
def _classes():
    """Class of each character below ``LATIN``, and ``HARD`` for what numpy leaves to the library."""
    table = np.full(LATIN + 1, OTHER, dtype=np.uint8)
    for cp in range(LATIN):
        kind = unicodedata.category(chr(cp))
        if kind[0] == "L":
            table[cp] = LETTER
        elif kind[0] == "N":
            table[cp] = NUMBER
    table[[9, 10, 11, 12, 13, 0x20, 0x85, 0xA0]] = SPACE
    # An apostrophe may start a contraction; the dotted capital I becomes two characters in lower case.
    table[[0x27, 0x130, LATIN]] = HARD
    return table


@functools.cache
def _lower():
    return np.array([ord(chr(cp).lower()) if len(chr(cp).lower()) == 1 else cp for cp in range(LATIN)], dtype=np.uint32)


@functools.cache
def load(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class Words:
    """The words of some texts: ``codes`` into ``distinct``, and the bounds of each text's codes."""

    def __init__(self, codes, first, distinct):
        self.codes, self.first, self.distinct = codes, first, distinct

    def of(self, i):
        return self.codes[self.first[i]:self.first[i + 1]]


def _by_class(points, starts, ends, kind):
    """Starts and ends of the words of texts that lie one after the other in ``points``."""
    classes = _classes()[points]
    n = len(points)
    before = np.empty(n, dtype=np.uint8)
    before[1:] = classes[:-1]
    head = np.zeros(n + 1, dtype=bool)
    head[starts] = True
    opening = head[:n]
    space = classes == SPACE
    if kind == "clip":
        begin = (opening | (classes != before) | (classes == NUMBER)) & ~space
        edge = begin | (opening | (classes != before))
        at = np.flatnonzero(edge)
        stop = np.append(at[1:], n)
        real = ~space[at]
        return at[real], stop[real]
    blank = points == 0x20
    after_space = np.empty(n, dtype=bool)
    after_blank = np.empty(n, dtype=bool)
    after_space[1:], after_blank[1:] = space[:-1], blank[:-1]
    closing = head[1:]
    next_space = np.append(space[1:], False)
    last_of_run = space & ~next_space & ~closing
    begin = opening | np.where(space, ~after_space | last_of_run, (classes != before) & ~(after_space & after_blank))
    at = np.flatnonzero(begin)
    return at, np.append(at[1:], n)


SPECIAL = ("<|endoftext|>", "<|startoftext|>")


def _by_library(tokenizer, text):
    """Words of one text, special tokens apart, as the library splits it."""
    pieces, rest = [], text
    known = [s for s in SPECIAL if tokenizer.token_to_id(s) is not None]
    while rest:
        hits = [(rest.find(s), s) for s in known if s in rest]
        at, special = min(hits) if hits else (len(rest), "")
        part = rest[:at]
        if part and tokenizer.normalizer is not None:
            part = tokenizer.normalizer.normalize_str(part)
        if part:
            pieces += [part[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        if special:
            pieces.append(special)
        rest = rest[at + len(special):]
    return pieces


def _library_only(strings, path):
    index, parts = {}, []
    for s in strings:
        own = [index.setdefault(w, len(index)) for w in _by_library(load(path), s)]
        parts.append(np.array(own, dtype=np.int64))
    first = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    return Words(np.concatenate(parts), first, list(index))


def split(strings, path, kind):
    """The :class:`Words` of ``strings`` (null: empty)."""
    import pandas as pd

    n = len(strings)
    strings = [s or "" for s in strings]
    raw = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=n)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    classes = _classes()[np.minimum(raw, LATIN)]
    # What the library must split: a hard character, or the two that open a special token.
    bad = classes == HARD
    if len(raw) > 1:
        bad[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    hard = np.add.reduceat(np.append(bad, False), np.minimum(starts, len(raw))) > 0 if n else np.zeros(0, bool)
    hard &= lengths > 0
    easy = ~hard & (lengths > 0)
    keep = np.repeat(easy, lengths)
    points = raw[keep]
    if kind == "clip":
        points = _lower()[points]
    sizes = lengths[easy]
    stop = np.cumsum(sizes)
    a, b = _by_class(points, stop - sizes, stop, kind) if len(points) else (np.empty(0, np.int64),) * 2
    values = points.astype(np.uint64) + np.uint64(1)
    one, two = (spans.SpanHasher(values * np.uint64(0xFF51AFD7ED558CCD), seed)(a, b) for seed in (3, 4))
    codes, uniques = pd.factorize(one)
    place = np.empty(len(uniques), dtype=np.int64)
    place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    if not np.array_equal(two[place][codes], two):  # two words share a hash: the library splits these texts
        return _library_only(strings, path)
    whole = points.tobytes().decode("utf-32-le") if len(points) else ""
    distinct = [whole[i:j] for i, j in zip(a[place].tolist(), b[place].tolist(), strict=True)]
    counts = np.zeros(n, dtype=np.int64)
    owner = np.searchsorted(stop, a, side="right")
    counts[np.flatnonzero(easy)] = np.bincount(owner, minlength=len(sizes))[:len(sizes)]
    if not hard.any():
        return Words(codes, np.concatenate(([0], np.cumsum(counts))), distinct)
    tokenizer, index = load(path), {w: i for i, w in enumerate(distinct)}
    parts, at = [], 0
    for i in range(n):
        if hard[i]:
            own = np.fromiter((index.setdefault(w, len(index)) for w in _by_library(tokenizer, strings[i])), dtype=np.int64)
            counts[i] = len(own)
            parts.append(own)
        else:
            parts.append(codes[at:at + counts[i]])
            at += counts[i]
    return Words(np.concatenate(parts), np.concatenate(([0], np.cumsum(counts))), list(index))


@functools.cache
def _byte_model(path):
    """The library's model of a tokenizer that does nothing to a word but to write its bytes as characters, and these
    characters; None for other tokenizers."""
    tokenizer = load(path)
    stages = json.loads(tokenizer.to_str())
    before = stages["pre_tokenizer"] or {}
    if stages["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    alphabet = "".join(chr(b if b in shown else next(hidden)) for b in range(256))
    added = {a["content"] for a in stages["added_tokens"]}
    return tokenizer.model, alphabet, added


def encode_words(words, path):
    """Token ids of each word, which the library encodes on its own, as one list per word."""
    tokenizer, out = load(path), []
    if _byte_model(path):
        # A word passes the stages before the model whole: the model alone spares an encoding's other members.
        model, alphabet, added = _byte_model(path)
        for w in words:
            if w in added:
                out.append(tokenizer.encode(w, add_special_tokens=False).ids)
            else:
                out.append([t.id for t in model.tokenize(codecs.charmap_decode(w.encode(), "strict", alphabet)[0])])
        return out
    for first in range(0, len(words), 4096):
        out += [e.ids for e in tokenizer.encode_batch_fast(words[first:first + 4096], add_special_tokens=False)]
    return out


def expand(codes, at, n, flat):
    """Ids of coded words one after the other, and how many stand before each word (and after the last).

    ``at`` and ``n`` say where a word's ids lie in ``flat`` and how many they are."""
    if not len(codes):
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    sizes = n[codes]
    ends = np.cumsum(sizes)
    # An id's place is its word's start plus its place in the word.
    place = np.arange(ends[-1]) + np.repeat(at[codes] - (ends - sizes), sizes)
    return flat[place], np.concatenate(([0], ends))


#: Words whose ids a Python worker remembers from one batch and task to the next.
REMEMBERED = 400_000
_remembered = {}


class _Memory:
    """Ids of words, one word's after the other's in ``flat``: ``index`` numbers the words, ``at`` and ``n`` say where theirs lie."""

    def __init__(self):
        self.index, self.flat, self.at, self.n = {}, np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, words, path):
        ids = encode_words(words, path)
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))
        self.at = np.concatenate((self.at, len(self.flat) + np.cumsum(n) - n))
        self.n = np.concatenate((self.n, n))
        self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(n.sum()))))


def encode_texts(strings, path, kind):
    """All ids of ``strings`` one after the other and the bounds of each text's; each distinct word is encoded once."""
    words = split(strings, path, kind)
    known = _remembered.setdefault(path, _Memory())
    place = np.fromiter((known.index.get(w, -1) for w in words.distinct), np.int64, len(words.distinct))
    if len(known.index) + int((place < 0).sum()) > REMEMBERED:
        known = _remembered[path] = _Memory()
        place[:] = -1
    missing = np.flatnonzero(place < 0)
    if len(missing):
        place[missing] = len(known.index) + np.arange(len(missing))
        known.add([words.distinct[i] for i in missing.tolist()], path)
    out, before = expand(words.codes, known.at[place], known.n[place], known.flat)
    return out, before[words.first]
