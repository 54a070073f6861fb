"""Token ids of whole texts by a public tokenizer file, with a cache of pieces in each worker.

A text is cut at single blanks that stand between two other characters, around
single line feeds, and before a comma or full stop that ends a word.  The
pre-tokenizers of both supported kinds never join what such a cut parts, so the
ids of a text are the ids of its pieces one after another, and each distinct
piece is encoded by the tokenizers library once and then looked up.  Texts that
may hold one of the vocabulary's special tokens are encoded whole, by one plain
call each.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces that a worker remembers, about 200 bytes each; beyond it only those that came again stay.
CACHED = 900_000
#: Ids that the remembered pieces have together at most.
POOLED = 8 << 20
#: Longer pieces are encoded but not remembered.
LONGEST = 80
#: Marks a piece that has no blank before it; texts that hold it take the careful way.
BARE = "\x01"
#: White space other than single blanks and line feeds between other characters.
SIDE_BY_SIDE = "  |\\n\\n| \\n|\\n |[ \\n]$|^[ \\n]|[\\x00\\x01\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: A comma or full stop after a Latin letter, where the word ends; U+0130 is none of these, as its lower case ends in a combining dot.
STOP, STOP_APART = "([A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{12f}\\x{131}-\\x{24f}])([,.])( |\\n|$)", f"\\1 {BARE}\\2\\3"


class Encoder:
    """Ids as unsigned 32-bit integers."""

    def __init__(self, path: str, cached: int = CACHED):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        #: How special tokens begin: such a text is encoded whole.
        self.special = "|".join(sorted({re.escape(t["content"][:2]) for t in described["added_tokens"]})) or "$^"
        #: Whether blanks belong to tokens (byte-level vocabularies) or are dropped.
        self.keeps_blanks = described["pre_tokenizer"]["type"] == "ByteLevel"
        #: Piece to number; a piece's ids are pool[starts[number] : starts[number + 1]].
        self.cache: dict[str, int] = {}
        self.pool, self.starts = np.empty(0, "<u4"), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)
        # what parts pieces when many are encoded at once: a character that is one token wherever it stands between blanks
        marks = ["\n"] if self.keeps_blanks else ["§", "¶", "|", "~"]
        ids = {m: self.plain(m) for m in marks}
        self.mark = next(m for m in marks if len(ids[m]) == 1)
        # pieces with blanks inside, or the mark, are encoded one by one
        self.is_odd = re.compile(f"^$|^[\\s{self.mark}]$|.[\\s{self.mark}]|^[\\n{self.mark}]", re.DOTALL).search
        self.mark_id, self.between = ids[self.mark][0], self.mark if self.keeps_blanks else f" {self.mark} "

    def plain(self, text: str) -> np.ndarray:
        """The ids of a plain call."""
        [e] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(e.ids, dtype="<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text's ids begin and the last ones end.

        Cutting and finding the distinct pieces is Arrow's work; Python sees each
        distinct piece of the batch once.
        """
        # a copy that begins at its buffers' beginning: not every function minds a slice's offset
        texts = pc.take(pc.fill_null(texts.cast(pa.large_string()), ""), pa.array(np.arange(len(texts))))
        careful = pc.match_substring_regex(texts, f"{self.special}|{SIDE_BY_SIDE}" if self.keeps_blanks else f"{self.special}|[\\x00\\x01]")
        empty = pa.scalar("", pa.large_string())
        easy = pc.replace_substring_regex(pc.if_else(careful, empty, texts), STOP, STOP_APART)
        if self.keeps_blanks:
            easy = pc.binary_join_element_wise(pa.scalar(BARE, pa.large_string()), pc.replace_substring(easy, "\n", f" {BARE}\n {BARE}"), empty)
        else:
            easy = pc.ascii_lower(pc.replace_substring(easy, "\n", " "))
        cut = pc.split_pattern(easy, " ")
        bounds = cut.offsets.to_numpy()
        pieces = cut.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.keeps_blanks:
            distinct = [p[1:] if p[:1] == BARE else " " + p for p in distinct]
        else:
            distinct = [p[1:] if p[:1] == BARE else p for p in distinct]
        ids, ends = self._ids(distinct, pieces.indices.to_numpy())
        offsets = np.concatenate([[0], ends])[bounds - bounds[0]]
        if not pc.any(careful).as_py():
            return ids, offsets
        parts = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
        for i in np.flatnonzero(careful.to_numpy(zero_copy_only=False)).tolist():
            parts[i] = self._careful(texts[i].as_py())
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _ids(self, distinct: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces distinct[at], and where each piece's ids end."""
        number = self._numbers(distinct)[at]
        first = self.starts[number]
        n = self.starts[number + 1] - first
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat((first - (ends - n)).astype(np.int32), n) + np.arange(total, dtype=np.int32)], ends

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """The pieces' numbers; unknown pieces are learnt."""
        get = self.cache.get
        found = np.fromiter((get(p, -1) for p in distinct), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        if len(self.cache) + len(new) > self.cached or len(self.pool) > POOLED:
            self._forget(len(new))
            get = self.cache.get
            found = np.fromiter((get(p, -1) for p in distinct), np.int64, len(distinct))
            new = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(new):
            found[new] = self._learn([distinct[i] for i in new.tolist()])
        return found

    def _forget(self, coming: int) -> None:
        """Pieces that came again stay, unless they fill the cache by themselves."""
        kept = [(p, i) for p, i in self.cache.items() if self.again[i]]
        if len(kept) + coming > 0.7 * self.cached:
            kept = []
        number = np.array([i for _, i in kept], np.int64)
        self.cache = {p: i for i, (p, _) in enumerate(kept)}
        n = self.starts[number + 1] - self.starts[number]
        ends = np.cumsum(n)
        self.pool = self.pool[np.repeat(self.starts[number] - (ends - n), n) + np.arange(int(n.sum()))]
        self.starts, self.again = np.concatenate([[0], ends]).astype(np.int64), np.zeros(len(kept), bool)

    def _learn(self, new: list[str]) -> np.ndarray:
        """Adds distinct pieces to the pool and, unless they are long, to the cache; their numbers."""
        first, odd, order, pools, sizes = len(self.starts) - 1, [], [], [], []
        plain = []
        for i, p in enumerate(new):
            (odd if self.is_odd(p) else plain).append(i)
        for at in range(0, len(plain), 500):
            here = plain[at : at + 500]
            ids = self.plain(self.between.join([new[i] for i in here]))
            is_mark = ids == self.mark_id
            cuts = np.flatnonzero(is_mark)
            if len(cuts) != len(here) - 1:
                odd += here
                continue
            order += here
            pools.append(ids[~is_mark])
            sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
        if odd:
            each = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([new[i] for i in odd], add_special_tokens=False)]
            order += odd
            pools += each
            sizes.append(np.array([len(x) for x in each]))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(np.concatenate(sizes))])
        self.pool = np.concatenate([self.pool, *pools])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        numbers = np.empty(len(new), np.int64)
        numbers[order] = np.arange(first, first + len(new))
        self.cache.update((p, i) for p, i in zip(new, numbers.tolist()) if len(p) <= LONGEST)
        return numbers

    def _careful(self, text: str) -> np.ndarray:
        """The ids of a text where blanks stand side by side, from pieces that keep those blanks together."""
        if "\0" in text or re.search(self.special, text):
            return self.plain(text)
        if not self.keeps_blanks:
            return self.plain(text)
        pieces = text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")
        joined = pieces[:1]
        for p in pieces[1:]:
            # a cut is right where a character that is no blank stands on both sides of the blank
            if len(p) < 2 or p[1].isspace() or joined[-1][-1:].isspace():
                joined[-1] += p
            else:
                joined.append(p)
        distinct = list(dict.fromkeys(joined))
        at = {p: i for i, p in enumerate(distinct)}
        return self._ids(distinct, np.array([at[p] for p in joined]))[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str, cached: int = CACHED) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path, cached)
