"""Token ids of texts by the ids of their distinct words.

The tokenizer's pieces never reach across white space, which it drops, so the
ids of a text are those of its white-space-delimited words in a row. A batch of
texts is cut and its words numbered by Arrow; only words that a worker has not
met are encoded. Most of those are letters with a tail of marks: the tokenizer
cuts them there and only folds case, so that the letters' ids come from its
model alone. Both properties are read from the tokenizer's file and tried out
when a worker opens it; where white space does not separate pieces it raises,
where words need more than the model they take the tokenizer's whole way.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from groundburn.llm.base import worker_cache

#: Letters that lower-case one to one and are never changed by composition: ASCII and precomposed Latin.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ɏ"
#: Letters, then ASCII marks without the apostrophe, which may begin a contraction.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PLAIN = re.compile(rf"([{_LETTERS}]+)[{re.escape(_MARKS)}]*")

#: What the plain way needs of a tokenizer: normalizers, pieces, and bytes as letters.
_STEPS = ("NFC", "Replace", "Lowercase")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PROBES = ("a", "The", "don't", "x,y", "naïve.", "Ünï", "12,345", "'s", "日本語", "\U0001f600!", "Ǆ", "ﬁ", "é", "́", "...", "word-word", "ÀÉ;", "şŞ", "ŉ")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes of Latin-1 for themselves, the others by 256 and up in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _listed(values: pa.Array) -> list:
    """As to_pylist(), many times as fast for short strings."""
    return values.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """One worker's tokenizer and the words it has met, in two generations of
    about ``cached`` words each. ``width``: bytes of an id."""

    def __init__(self, path: str, width: int = 2, cached: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use every core
        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << (8 * width):
            raise ValueError("an id needs more bytes for this vocabulary")
        self.type = f"<u{width}"
        self.width = width
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.letters = {b: c for b, c in enumerate(_byte_letters()) if chr(b) != c}
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._check_space()
        self.plain = self._is_plain(path)

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _check_space(self) -> None:
        apart = self._whole(list(_PROBES))
        for space in (" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"):
            for words, ids in ((_PROBES, apart), (_PROBES[::-1], apart[::-1])):
                if self._whole([space.join(["", *words, ""])])[0] != b"".join(ids):
                    raise ValueError("this tokenizer's pieces reach across white space")

    def _is_plain(self, path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normal, cut = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
        steps, cuts = normal.get("normalizers", []), cut.get("pretokenizers", [])
        known = (
            tuple(s["type"] for s in steps) == _STEPS and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": _SPLIT}
            and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])
        if not known:
            return False
        probes = [m[1].lower() for m in map(_PLAIN.fullmatch, _PROBES) if m]
        return self._letters_ids(probes) == self._whole(probes)

    def _letters_ids(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters, many in one string, by the model alone."""
        out: list[bytes] = []
        for k in range(0, len(words), 20_000):
            group = [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words[k:k + 20_000]]
            lines = [" ".join(group[i:i + 200]) for i in range(0, len(group), 200)]
            for i, e in enumerate(self.bare.encode_batch(lines, add_special_tokens=False)):
                ids = np.array(e.ids, self.type).tobytes()
                ends = np.searchsorted(np.array(e.word_ids), np.arange(min(200, len(group) - 200 * i) + 1)) * self.width
                ends = ends.tolist()
                out += [ids[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def _learn(self, words: list[str]) -> None:
        known, whole = self.new, words
        if self.plain:
            given = pa.array(words, pa.string())
            stems = pc.ascii_rtrim(given, characters=_MARKS)
            ascii_only = pc.ascii_is_alpha(stems)
            whole, cores, tails, plain = [], [], [], []
            for w, core, plain_core in zip(words, _listed(pc.ascii_lower(stems)), _listed(ascii_only), strict=True):
                if not plain_core:
                    m = _PLAIN.fullmatch(w)
                    if not m:
                        whole.append(w)
                        continue
                    core = m[1].lower()
                plain.append(w)
                cores.append(core)
                tails.append(w[len(core):])
            unseen = list(set(cores) - known.keys())
            known.update(zip(unseen, self._letters_ids(unseen), strict=True))
            whole += set(tails) - known.keys() - set(whole)
        for k in range(0, len(whole), 20_000):
            known.update(zip(whole[k:k + 20_000], self._whole(whole[k:k + 20_000]), strict=True))
        if self.plain:
            known.update(zip(plain, map(bytes.__add__, map(known.__getitem__, cores), map(known.__getitem__, tails)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): all texts' ids in a row, and where each text's end. Null has none."""
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        cut = pc.ascii_split_whitespace(texts)
        found = cut.flatten().dictionary_encode()
        words = _listed(found.dictionary)
        if len(self.new) > self.cached:
            self.old, self.new = self.new, {"": b""}
        own = list(map(self.new.get, words))
        missing = [w for w, ids in zip(words, own, strict=True) if ids is None]
        if missing:
            kept = [w for w in missing if w in self.old]
            self.new.update(zip(kept, map(self.old.__getitem__, kept)))
            self._learn([w for w in missing if w not in self.old])
            own = list(map(self.new.__getitem__, words))
        ids = np.frombuffer(b"".join(own), self.type)
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // self.width
        starts = np.cumsum(sizes) - sizes
        at = found.indices.to_numpy()
        times = sizes[at]
        upto = np.cumsum(times)
        total = int(upto[-1]) if len(upto) else 0
        place = np.repeat(starts[at] - upto + times, times) + np.arange(total)
        ends = np.append(0, upto)[cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()]
        return ids[place], ends


@worker_cache
def word_ids(path: str, width: int = 2, cached: int = 250_000) -> WordIds:
    """A worker's own, kept from task to task."""
    return WordIds(path, width, cached)


def by_bytes(texts: pa.Array, limit: int = 4 << 20) -> list[pa.Array]:
    """Consecutive runs of texts of at most so many bytes each, or one text."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    out, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + limit, side="right")))
        out.append(texts.slice(at, to - at))
        at = to
    return out
