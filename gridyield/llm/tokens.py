"""Token ids of the ``tokenizers`` library, with each distinct word encoded once per worker.

Byte-level tokenizers split a text before they merge, and a blank in front of a character that is no
white space always opens a new piece. So a text may be cut in front of such blanks, and its ids are
the ids of the parts one after the other. The parts repeat; the library encodes each new one, and its
ids are kept. Runs of plain letters, digits or marks are pieces for certain; the library's model takes them as they are, without its search for pieces.
Tokenizers of another kind, and texts that hold an added token, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

KEPT_WORDS = 1_500_000  # kept parts of a worker, about 200 bytes each; the older half makes room for new ones
TOGETHER = 2_000  # new parts that the library gets at a time
#: Blanks at which a text is not cut: in front of white space of either library, of marks that some versions count to it, or of the end.
NO_CUT = re.compile(r" (?=[\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2060\ufeff]|\Z)")
#: Runs that are a piece each, the first with the blank before it: letters of every version of Unicode, digits, marks but the apostrophe, a line end.
RUN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+|[!-&(-/:-@\[-`{-~]+|\n(?!\n)")
RUNS = re.compile(f"(?!\n)(?:{RUN.pattern})+")
_encoders: dict[tuple[str, bool], "Encoder"] = {}


def encoder(path: str, special_as_text: bool = False, kept_words: int = KEPT_WORDS) -> "Encoder":
    """One encoder per worker process and file; it keeps as many words as its last caller allows."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(path, special_as_text)
    _encoders[key].kept_words = kept_words
    return _encoders[key]


class Encoder:
    """ids(texts): one uint32 array per text, equal to the library's own with add_special_tokens=False."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        self.by_part = (
            parts.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space", True)
        )
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, bytes] = {}
        self.kept_words = KEPT_WORDS
        self.mark = {m: self._whole(m) for m in ".,"}
        if self.by_part:
            self.model, pieces = self.whole.model, self.whole.pre_tokenizer
            self.blank, *shown = ("".join(p for p, _ in pieces.pre_tokenize_str(c)) for c in " " + "".join(map(chr, range(0xC0, 0x250))) + "\n")
            *shown, line_end = shown
            self.shown = {10: line_end, **dict(zip(range(0xC0, 0x250), shown))}  # characters as the model knows them; those of ASCII stay

    def size(self) -> int:
        return self.whole.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """ids of blank + part for each part, from one call of the library for many."""
        found: dict[str, bytes] = {}
        for k in range(0, len(parts), TOGETHER):
            some = parts[k:k + TOGETHER]
            got = self.whole.encode(" " + " ".join(some), add_special_tokens=False)
            raw = np.array(got.ids, "<u4").tobytes()
            starts = np.fromiter((o[0] for o in got.offsets), np.int64, len(raw) // 4)
            lengths = np.fromiter(map(len, some), np.int64, len(some)) + 1
            borders = (np.searchsorted(starts, np.cumsum(lengths)) * 4).tolist()
            found.update(zip(some, (raw[a:b] for a, b in zip([0, *borders[:-1]], borders))))
        return found

    def _encode_runs(self, parts: list[str]) -> dict[str, bytes]:
        """The same for parts that match ``RUNS``."""
        tokenize, blank, shown, runs = self.model.tokenize, self.blank, self.shown, RUN.findall
        ids: list[int] = []
        ends = [0]
        for part in parts:
            if part.isalpha():
                ids += [t.id for t in tokenize(blank + (part if part.isascii() else part.translate(shown)))]
            else:
                first, *others = runs(part)
                for run in (blank + first.translate(shown), *(r.translate(shown) for r in others)):
                    ids += [t.id for t in tokenize(run)]
            ends.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return dict(zip(parts, (raw[a:b] for a, b in zip(ends, ends[1:]))))

    def _look_up(self, new: set[str]) -> dict[str, bytes]:
        """ids of blank + word for words that are not kept; keeps them, and lets the older half of the kept ones go when there are too many.

        A word of letters with a full stop or comma behind it is two pieces, so only its letters are encoded.
        """
        known, stems = self.known, {}
        for word in new:
            if word[-1] in self.mark and word[:-1].isalpha():
                stems[word] = word[:-1]
        wanted = [w for w in (new - stems.keys()) | set(stems.values()) if w not in known]
        found = self._encode_runs(list(filter(RUNS.fullmatch, wanted)))
        found.update(self._encode_parts([w for w in wanted if w not in found]))
        for word, stem in stems.items():
            found[word] = (known.get(stem) or found[stem]) + self.mark[word[-1]]
        known.update(found)
        if len(known) > self.kept_words:
            self.known = dict(islice(known.items(), len(known) - self.kept_words // 2, None))
        return found

    def _parts(self, text: str) -> list[str] | None:
        """The text up to the first cut, and the words behind the cuts without their blank."""
        if not self.by_part or self.added and self.added.search(text):
            return None
        words = text.split(" ")
        if NO_CUT.search(text):
            joined = words[:1]
            for word in words[1:]:
                if NO_CUT.match(" " + word):
                    joined[-1] += " " + word
                else:
                    joined.append(word)
            words = joined
        return words

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [self._parts(text) if text else [""] for text in texts]
        firsts = [words.pop(0) if words else None for words in parts]
        known = self.known
        new = set().union(*filter(None, parts)).difference(known)
        found = self._look_up(new) if new else {}
        out = []
        for text, first, words in zip(texts, firsts, parts):
            if words is None:
                raw = self._whole(text)
            else:
                try:
                    raw = b"".join(map(known.__getitem__, words))
                except KeyError:
                    raw = b"".join([known[w] if w in known else found[w] for w in words])
                if first:
                    raw = self._whole(first) + raw
            out.append(np.frombuffer(raw, "<u4"))
        return out
