"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece of text encoded once.

Byte-level BPE never joins what stands before a lone space or line break with what stands after it, so a text can be
cut there and each piece encoded by the library on its own; tests hold this against whole texts. Texts with other
white space, or two of these in a row, go to the library whole. Where a vocabulary cuts and lower-cases as ``LETTERS_ALONE`` says, new
pieces of Latin letters alone go to the library's model at once: its normaliser and its cutting would leave them as they are.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import held, without_gc

#: Distinct pieces held by a worker; beyond this it keeps those of the texts at hand. An executor may keep more workers than it runs tasks, each with its own.
#: Where case and spaces are dropped there are fewer of them and new ones cost less: half as many are held, some 110 MB.
MEMO = 1_066_666

#: Signs that may end a piece (fixed values).
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters up to U+017F that stand alone in normal form C and whose lower case is one of them, and how the library is to treat texts so that a piece of them is one word: normal form, white space, lower case; then runs of letters as bytes.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
LETTERS_ALONE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
)
#: White space besides spaces and line breaks (fixed values); texts with any are encoded whole.
OTHER_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def cuts_anywhere(t: str) -> bool:
    """Whether a text has just lone spaces and line breaks, none at its ends: then each of them parts it for the library too."""
    return not ("  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[0].isspace() or t[-1].isspace() or any(c in t for c in OTHER_SPACES))


def ends_in_letter(base: str) -> bool:
    """Whether a letter ends a piece before and after normalisation, so that signs behind it are tokens of their own. Some letters turn into a letter and a mark, which signs would join."""
    last = base[-1]
    return last.isalpha() and (last.isascii() or unicodedata.normalize("NFC", last).lower()[-1].isalpha())


class PieceEncoder:
    """``encode(texts)`` gives for each text its ids as little-endian unsigned 32-bit bytes; null counts as empty."""

    def __init__(self, path: str, drops_spaces: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.drops_spaces = drops_spaces
        # with spaces kept, a lone line break; else a control character between spaces, which are dropped
        self.sep = "\x02" if drops_spaces else "\n"
        self.mark = f" {self.sep} " if drops_spaces else self.sep
        (self.mark_id,) = self.library.encode(self.sep, add_special_tokens=False).ids
        # pieces with a special string, in whatever case, aren't taken apart
        self.special = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.line_break = np.array([self.mark_id], "<u4").tobytes()
        self.memo: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {"": b""}
        self.before = "" if drops_spaces else " "
        self.model, self.signs_of = None, {}
        if drops_spaces and self._letters_alone():
            from tokenizers.pre_tokenizers import ByteLevel

            cut = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.model = self.library.model
            self.signs_of = {n: cut(chr(n))[0][0] for n in range(128, 0x180)}

    def _letters_alone(self) -> bool:
        """Whether the library treats texts as ``LETTERS_ALONE`` says."""
        state = [self.library.normalizer, self.library.pre_tokenizer]
        normal, cut = (x and json.loads(x.__getstate__()) for x in state)
        in_letters = re.compile(f"(?:{LATIN.pattern})?[{re.escape(SIGNS)}]*").fullmatch
        return normal == LETTERS_ALONE[0] and cut == {"type": "Sequence", "pretokenizers": [*LETTERS_ALONE[1:]]} and not any(map(in_letters, self.special))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: Iterable[str]) -> None:
        """Put pieces that the memo lacks into it. A piece that begins with a line break stands alone, others follow a space."""
        memo, ends = self.memo, self.ends
        derived, plain, bare, marks = [], [], {}, set()
        special, latin = self.special, LATIN.fullmatch if self.model else lambda p: None
        letters = set()
        for p in new:  # signs after a letter are a token of their own; where case is dropped, so are capitals
            base = p.rstrip(SIGNS)
            if latin(base):
                low = base.lower()
                if low not in memo:
                    letters.add(low)
                if low != p:
                    end = p[len(base) :]
                    if end not in ends:
                        marks.add(end)
                    derived.append((p, low, end))
            elif base and base[0] == "\n":
                bare[p] = p[1:]
            elif special and any(x in p.lower() for x in special):
                plain.append(p)
            elif len(base) != len(p) and base and ends_in_letter(base):
                end = p[len(base) :]
                if end not in ends:
                    marks.add(end)
                derived.append((p, base.lower() if self.drops_spaces and base.isascii() else base, end))
            elif self.drops_spaces and p.isascii() and not p.islower() and (low := p.lower()) != p:
                derived.append((p, low, ""))
            else:
                plain.append(p)
        memo.update(self._of_letters(letters))
        plain += {b for _, b, _ in derived if b not in memo}.difference(plain) if derived else ()
        memo.update(self._encoded(plain, self.before))
        if marks:
            ends.update(self._encoded(list(marks), ""))
        for p, base, end in derived:
            memo[p] = memo[base] + ends[end]
        found = self._encoded(list(bare.values()), "")
        for p, x in bare.items():
            memo[p] = self.line_break + found[x]

    def _of_letters(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Encode lower-cased pieces of ``LATIN`` by the library's model."""
        flat, ends = [], [0]
        for p in pieces:
            flat += [t.id for t in self.model.tokenize(p if p.isascii() else p.translate(self.signs_of))]
            ends.append(len(flat) * 4)
        raw = np.array(flat, "<u4").tobytes()
        return zip(pieces, [raw[a:b] for a, b in zip(ends, ends[1:])])

    def _encoded(self, pieces: list[str], before: str) -> dict[str, bytes]:
        """Encode by the library: many in one text, parted by a mark whose id none of them can yield."""
        out: dict[str, bytes] = {}
        for i in range(0, len(pieces), 4096):
            part = pieces[i : i + 4096]
            joined = self.mark.join([before + p for p in part])
            if joined.count(self.sep) == len(part) - 1:
                ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                at = np.flatnonzero(ids == self.mark_id)
                if len(at) == len(part) - 1:
                    raw, begins, ends = ids.tobytes(), [0, *((at + 1) * 4).tolist()], [*(at * 4).tolist(), len(ids) * 4]
                    out.update(zip(part, [raw[a:b] for a, b in zip(begins, ends)]))
                    continue
            out.update(zip(part, self.whole([before + p for p in part])))
        return out

    def _evict(self, at_hand) -> None:
        if len(self.ends) > 10_000:
            self.ends = {"": b""}
        if len(self.memo) > (MEMO // 2 if self.drops_spaces else MEMO):
            self.memo = dict(at_hand)

    def _without_spaces(self, texts: list[str | None]) -> list[bytes]:
        """Where spaces are dropped: the texts' distinct pieces are looked up, and Arrow puts their ids in the pieces' places."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(pa.array(texts, pa.large_string()), ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        pieces = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.memo.get, pieces))
        holes = [i for i, x in enumerate(found) if x is None]
        self.learn([pieces[i] for i in holes])
        for i in holes:
            found[i] = self.memo[pieces[i]]
        ids = pa.array(found, pa.large_binary()).take(words.indices)
        self._evict(zip(pieces, found))
        _, at, raw = ids.buffers()
        at, raw = np.frombuffer(at, np.int64)[lists.offsets.to_numpy()].tolist(), memoryview(raw)
        return [bytes(raw[a:b]) for a, b in zip(at, at[1:])]

    @without_gc
    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.drops_spaces:
            return self._without_spaces(texts)
        cut: list[tuple[list[str], list[bytes | None], list[int]] | None] = []
        odd: list[str] = []
        new: set[str] = set()
        get = self.memo.get
        for t in texts:
            if not t:
                pieces = []
            elif not cuts_anywhere(t):
                cut.append(None)
                odd.append(t)
                continue
            else:  # a line break before the text is put there and taken off again
                pieces = f"\n{t}".replace("\n", " \n").split(" ")
                del pieces[0]
            # one look at the memo per piece: it is too large for the CPU's caches
            found = list(map(get, pieces))
            holes, at = [], -1
            with suppress(ValueError):
                while True:
                    at = found.index(None, at + 1)
                    holes.append(at)
            new.update([pieces[i] for i in holes])
            cut.append((pieces, found, holes))
        self.learn(new)
        memo, whole, out = self.memo, iter(self.whole(odd)), []
        for c in cut:
            if c is None:
                out.append(next(whole))
                continue
            pieces, found, holes = c
            for i in holes:
                found[i] = memo[pieces[i]]
            out.append(b"".join(found)[4:])
        self._evict((p, memo[p]) for c in cut if c for p in c[0])
        return out


def encoder(path: str, drops_spaces: bool = False) -> PieceEncoder:
    """A worker's encoder for a vocabulary; what it has learned stays for its next tasks."""
    return held(("encoder", path, drops_spaces), lambda: PieceEncoder(path, drops_spaces))
