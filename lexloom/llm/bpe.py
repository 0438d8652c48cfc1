"""Exact BPE encoding and decoding of whole texts with a public vocabulary (op3, and the token source of packing).

Method: *tree concatenation*.  A long text is halved until its leaves are short, the leaves are encoded independently
(by different tasks: ``leaves`` spreads them over the cluster), and neighbours are joined by re-encoding a window round
the cut.  The window doubles until its first atom is the left side's atom at that place and one of its later atoms is
the right side's atom at its place; then everything outside the window stands as it was encoded.

An *atom* is a run of text without ASCII white space together with its ids; runs longer than ``LONG_RUN`` code points
are taken apart into their single tokens.  White space runs are context-free for the supported tokenizers (the
pre-tokenizer never spans them), and inside a run the usual property of rank-ordered BPE holds: a sequence whose
neighbouring tokens are each neighbours in some correct encoding is itself the correct encoding.  When no agreement
is found the window has grown to the whole text, so the result is exact in every case.  Leaves keep atoms only near their
ends; what lies between, from white space to white space, is kept as packed ids (``Rope``) and no join has to look at it.

Defined results: a null text counts as empty, empty text has no ids and decodes to the empty string; equal rows give
equal rows; extra columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Code points of a leaf; a text up to this long is one leaf.
LEAF = 32_768
#: Code points at either end of a leaf, at least, that are kept as atoms for its joins; a join never looks further.
EDGE = 512
#: Runs without white space that are longer are joined token by token.
LONG_RUN = 2_048
#: First window on either side of a cut, in code points.
WINDOW = 64
#: Words and parts of words whose ids a worker remembers (about 200 bytes each); the older half goes when it is full.
CACHE = 300_000

RUN = re.compile(r"[^ \t-\r]+")
BLANKS = " \t\n\x0b\x0c\r"
BLANK = re.compile("[ \t-\r]")
#: Classes of bytes for the pre-tokenizer's rule (contractions, runs of letters, single digits, runs of anything else but
#: white space) in UTF-8 text of ASCII and lower-case Latin-1 letters.
WHITE, LETTER, DIGIT, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[list(b" \t\n\x0b\x0c\r")], KIND[ord("a") : ord("z") + 1], KIND[0x80:], KIND[ord("0") : ord("9") + 1] = WHITE, LETTER, LETTER, DIGIT
#: Words that may be cut by these classes: no control, no combining or special characters, nothing that a normalizer changes.
SAFE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Texts of such words.
SAFE_TEXT = re.compile("[!-~À-ÖØ-öø-ÿ \\t-\\r]*")

Atom = tuple[int, int, tuple[int, ...]]


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes like ``tokenizers`` with ``add_special_tokens=False`` and neither truncation nor padding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        bare = Tokenizer.from_file(path)
        self.words = Tokenizer(bare.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            self.names[i] = name
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ends = np.array([n.endswith("</w>") for n in self.names])
        self.letters = byte_letters()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.past: dict[bytes, bytes] = {}
        #: The short way below holds for vocabularies that mark word ends and lower the case; others take the library.
        self.short = self._short()

    def _short(self) -> bool:
        probe = "The don't a1é'LL !!'s ÀÖß x_y 12% ## it's"
        got = self._plain([probe])
        return got is not None and list(unpack(got[0])) == self.library.encode(probe, add_special_tokens=False).ids

    def _plain(self, texts: list[str]) -> list[bytes] | None:
        """Packed ids of texts of SAFE words by way of the words' parts; None if a part is too long or has no word end.

        The texts are cut as one array of bytes, equal parts are looked up once, and their ids are laid out by numpy.
        """
        raw = [t.lower().encode() for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n\n\n", np.uint8)
        kind = KIND[data]
        ink = kind != WHITE
        begins = kind == DIGIT
        begins[0] = True
        begins[1:] |= kind[1:] != kind[:-1]
        begins &= ink
        mark = np.flatnonzero(begins & (data == ord("'")))  # contractions begin where a part does
        if len(mark):
            one, two = data[mark + 1], data[mark + 2]
            for hit, size in ((np.isin(one, list(b"stmd")), 2), (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")), 3)):
                begins[mark[hit] + 1] = False
                begins[mark[hit] + size] |= ink[mark[hit] + size]
        starts, letters = np.flatnonzero(begins), data[ink]
        if not len(starts):
            return [b""] * len(texts)
        offsets = np.append(np.flatnonzero(begins[ink]), len(letters)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        which, ids = coded.indices.to_numpy(), self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if ids is None:
            return None
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        firsts = np.cumsum(sizes) - sizes
        count = sizes[which]
        stops = np.cumsum(count)
        laid = pack_array(np.frombuffer(b"".join(ids), "<u4")[np.repeat(firsts[which] - (stops - count), count) + np.arange(stops[-1])])
        edge = np.cumsum([0, *(len(r) + 1 for r in raw)])
        at = (4 * np.append(0, stops)[np.searchsorted(starts, edge)]).tolist()
        return [laid[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _known(self, words: list[bytes]) -> list[bytes] | None:
        """Packed ids of parts; those that are not remembered are encoded together."""
        ids = list(map(self.parts.get, words))
        missing = [k for k, i in enumerate(ids) if i is None]
        if not missing:
            return ids
        if len(self.parts) + len(missing) > CACHE // 2:
            self.past, self.parts = self.parts, {}
        new = []
        for k in missing:
            if (old := self.past.get(words[k])) is None:
                new.append(k)
            else:
                ids[k] = self.parts[words[k]] = old
        if any(len(words[k]) > LONG_RUN for k in new):
            return None
        for n in range(0, len(new), 16_384):
            some = new[n : n + 16_384]
            plain = [w.decode() if w.isascii() else "".join([self.letters[b] for b in w]) for w in map(words.__getitem__, some)]
            coded = self.words.encode_batch_fast([" ".join(plain[j : j + 64]) for j in range(0, len(plain), 64)], add_special_tokens=False)
            flat = np.fromiter((i for e in coded for i in e.ids), "<u4")
            stops = np.flatnonzero(self.ends[flat]) + 1
            if len(stops) != len(some) or stops[-1] != len(flat):
                return None
            raw, at = flat.tobytes(), 0
            for k, stop in zip(some, (4 * stops).tolist(), strict=True):
                ids[k] = self.parts[words[k]] = raw[at:stop]
                at = stop
        return ids

    def learn(self, words: set[bytes]) -> None:
        """Adds the ids of those words that are not remembered."""
        missing = words.difference(self.young)
        if missing and len(self.young) + len(missing) > CACHE // 2:
            self.old, self.young, missing = self.young, {}, words
        easy, hard = [], []
        for w in missing:
            if w in self.old:
                self.young[w] = self.old[w]
            elif self.short and len(w) <= LONG_RUN and b"<|" not in w and SAFE.fullmatch(w.decode()):
                easy.append(w)
            else:
                hard.append(w)
        for k in range(0, len(easy), 65_536):
            part = easy[k : k + 65_536]
            got = self._plain([w.decode() for w in part])
            if got is None:
                hard += part
            else:
                self.young.update(zip(part, got, strict=True))
        for w in hard:
            text = w.decode()
            self.young[w] = pack([i for _, _, ids in self._run(text, 0) for i in ids])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text: words, or their parts, by the memory, long runs by tree concatenation."""
        if self.short and all("<|" not in t and SAFE_TEXT.fullmatch(t) for t in texts) and (got := self._plain(texts)) is not None:
            return got
        if len(texts) > 1:
            return [self.encode_batch([t])[0] for t in texts]
        split = [t.encode().split() for t in texts]
        self.learn(set().union(*split))
        get = self.young.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def _tokens(self, text: str, at: int) -> list[Atom]:
        """An atom for every token; tokens that share code points (parts of one character) make one atom."""
        e = self.library.encode(text, add_special_tokens=False)
        out: list[Atom] = []
        for i, (a, b) in zip(e.ids, e.offsets, strict=True):
            if out and at + a < out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], at + b), (*out[-1][2], i))
            else:
                out.append((at + a, at + b, (i,)))
        return out

    def _run(self, run: str, at: int) -> list[Atom]:
        """One run without white space."""
        if len(run) <= LONG_RUN:
            return [(at, at + len(run), tuple(self.library.encode(run, add_special_tokens=False).ids))]
        mid = len(run) // 2
        return self.join(lambda a, b: run[a - at : b - at], self._half(run[:mid], at), self._half(run[mid:], at + mid), at, at + mid, at + len(run))

    def _half(self, run: str, at: int) -> list[Atom]:
        if len(run) <= LONG_RUN:
            return self._tokens(run, at)
        mid = len(run) // 2
        return self.join(lambda a, b: run[a - at : b - at], self._half(run[:mid], at), self._half(run[mid:], at + mid), at, at + mid, at + len(run))

    def atoms(self, text: str, at: int = 0, halve: bool = True) -> list[Atom]:
        """The atoms of a text that starts at code point ``at``; without halve, long runs are encoded in one go."""
        runs = [(m.start(), m.group()) for m in RUN.finditer(text)]
        self.learn({r.encode() for _, r in runs if len(r) <= LONG_RUN})
        out: list[Atom] = []
        for start, r in runs:
            out += [(at + start, at + start + len(r), unpack(self.young[r.encode()]))] if len(r) <= LONG_RUN else (self._run if halve else self._tokens)(r, at + start)
        return out

    def join(self, text: Callable[[int, int], str], left: list[Atom], right: list[Atom], first: int, cut: int, last: int) -> list[Atom]:
        """The atoms of text(first, last) from those of text(first, cut) and text(cut, last)."""
        size = WINDOW
        starts, ends = [a[0] for a in left], {a[:2]: (k, a[2]) for k, a in enumerate(right[: 4 * WINDOW + 4])}
        while True:
            if len(ends) < len(right) and len(ends) < size:
                ends = {a[:2]: (k, a[2]) for k, a in enumerate(right[: 4 * size])}
            a = max(0, bisect.bisect_right(starts, cut - size) - 1)
            begin = left[a][0] if left and starts[a] <= cut - size else first
            if begin == first:
                a = 0
            end = min(last, cut + size)
            window = text(begin, end)
            # inside a long run the atoms are tokens; elsewhere they are whole runs
            whole = begin == first and end == last
            if whole:  # nothing agreed, as in long repeats of one letter
                return self.atoms(window, begin, halve=False)
            got = self._tokens(window, begin) if self._inside(text, begin, end, first, last) else self.atoms(window, begin)
            same_left = begin == first or (got and a < len(left) and got[0] == left[a])
            if same_left:
                for k in range(len(got) - 1):  # the last atom may be cut by the window's end
                    s, e, ids = got[k]
                    if s >= cut and (hit := ends.get((s, e))) and hit[1] == ids:
                        return left[:a] + got[: k + 1] + right[hit[0] + 1 :]
                if end == last and not right:
                    return left[:a] + got
            size *= 2

    @staticmethod
    def _inside(text: Callable[[int, int], str], begin: int, end: int, first: int, last: int) -> bool:
        """Whether the window starts or ends within a run, or holds a long one."""
        edge = text(max(first, begin - 1), begin) + "|" + text(begin, min(begin + 1, last))
        within = begin > first and not re.search(r"[ \t-\r]", edge)
        return within or any(len(r) > LONG_RUN for r in RUN.findall(text(begin, end)))

    def decode(self, ids: tuple[int, ...] | list[int]) -> str:
        return self.library.decode(ids, skip_special_tokens=False)


def pack(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    import array
    import sys

    a = array.array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def pack_array(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def unpack(raw: bytes) -> tuple[int, ...]:
    return tuple(np.frombuffer(raw, "<u4").tolist())


class Rope(NamedTuple):
    """An encoded stretch of text: atoms at its ends, packed ids between them; without a middle, head holds all atoms.

    A middle lies between white space, so that what is next to it doesn't change its ids.
    """

    start: int
    stop: int
    head: list[Atom]
    middle: bytes | None
    tail: list[Atom]

    def packed(self) -> bytes:
        flat = lambda atoms: pack([i for a in atoms for i in a[2]])
        return flat(self.head) + (self.middle or b"") + flat(self.tail)


def leaves(enc: Encoder, texts: list[str], starts: list[int], edge: int = EDGE) -> list[Rope]:
    """Leaves by the code points where they start."""
    cuts = []
    for t in texts:
        a, b = BLANK.search(t, edge), max(t.rfind(c, 0, max(0, len(t) - edge)) for c in BLANKS)
        cuts.append((a.start(), b) if a and a.start() < b else None)
    middles = iter(enc.encode_batch([t[c[0] : c[1]] for t, c in zip(texts, cuts, strict=True) if c]))
    ropes = []
    for t, c, at in zip(texts, cuts, starts, strict=True):
        if c:
            ropes.append(Rope(at, at + len(t), enc.atoms(t[: c[0]], at), next(middles), enc.atoms(t[c[1] :], at + c[1])))
        else:
            ropes.append(Rope(at, at + len(t), enc.atoms(t, at), None, []))
    return ropes


def joined(enc: Encoder, text: str, left: Rope, right: Rope) -> Rope:
    """Two neighbours as one.  The atoms that meet there reach to white space, or to the end of their side."""
    near = left.head if left.middle is None else left.tail
    first = left.start if left.middle is None else near[0][0] if near else left.stop
    last = right.stop if right.middle is None else right.head[-1][1] if right.head else right.start
    atoms = enc.join(lambda a, b: text[a:b], near, right.head, first, left.stop, last)
    if left.middle is None:
        return Rope(left.start, right.stop, atoms, right.middle, right.tail)
    if right.middle is None:
        return Rope(left.start, right.stop, left.head, left.middle, atoms)
    return Rope(left.start, right.stop, left.head, left.middle + pack([i for a in atoms for i in a[2]]) + right.middle, right.tail)


def tree(enc: Encoder, text: str, ropes: list[Rope]) -> bytes:
    """Joins leaves pairwise up to the whole text: its packed ids."""
    while len(ropes) > 1:
        up = [joined(enc, text, ropes[k], ropes[k + 1]) for k in range(0, len(ropes) - 1, 2)]
        ropes = up + ropes[len(ropes) & ~1 :]
    return ropes[0].packed() if ropes else b""
