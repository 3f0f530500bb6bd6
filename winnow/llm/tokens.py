"""Token ids of whole texts, encoding each distinct stretch of text once.

The two pre-tokenizers read here never let a token reach across a space that stands between other characters, so a text can be
cut there and a stretch's ids do not depend on its neighbours. Texts with runs of white space that
such a cut would change are encoded whole.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = "\x1f"
#: White space next to white space, where a cut would change the tokens of a byte-level pre-tokenizer; or the mark itself.
ODD_SPACES = "[\\p{Z}\\t-\\r\\x{85}\\x1c-\\x1f]{2}|\\x1f"
#: A stretch without white space behind its first character; such ones may stand in one text between marks.
JOINED = "^ ?[^\\p{Z}\\t-\\r\\x{85}\\x1c-\\x1f]+$"
#: Stretches joined in one text: a text of its own for each costs more than its tokens.
TOGETHER = 256


class TokenEncoder:
    """Ids by the tokenizers library; up to ``remembered`` distinct stretches are kept between calls, recent ones first."""

    def __init__(self, path: str, remembered: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.size = self.tokenizer.get_vocab_size()
        before = spec.get("pre_tokenizer") or {}
        kinds = [p.get("type") for p in before.get("pretokenizers", [])]
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.drops_space = kinds == ["Split", "ByteLevel"] and not self._direct([" \n\t "])[0].size
        self.cuts = bool(self.drops_space or (byte_level and not spec.get("normalizer")))
        self.folds = self.drops_space and '"Lowercase"' in json.dumps(spec.get("normalizer"))
        # stands between joined stretches and is a token that none of them holds
        self.mark = " \x1f " if self.drops_space else "\n"
        alone = self._direct([self.mark])[0]
        self.mark_id = int(alone[0]) if len(alone) == 1 else -1
        self.remembered = remembered
        self.known = pa.array([], pa.large_string())
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learnt(self, fresh: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches one after another, and how many each has. Those that may be joined are encoded ``TOGETHER`` to a text."""
        alike = pc.match_substring_regex(fresh, JOINED)
        joined, own = fresh.filter(alike).to_pylist(), fresh.filter(pc.invert(alike)).to_pylist()
        groups = [joined[k:k + TOGETHER] for k in range(0, len(joined), TOGETHER)]
        together = self._direct([self.mark + self.mark.join(g) for g in groups])
        ids = np.concatenate([*together, np.zeros(0, np.uint32)])
        marks = np.flatnonzero(ids == self.mark_id)
        if len(marks) != len(joined):  # a mark is no token of its own here
            apart = self._direct(fresh.to_pylist())
            return np.concatenate([*apart, np.zeros(0, np.uint32)]), np.fromiter(map(len, apart), np.int64, len(apart))
        apart = self._direct(own)
        sizes = np.zeros(len(fresh), np.int64)
        alike = np.asarray(alike)
        sizes[alike] = np.diff(np.append(marks, len(ids))) - 1
        sizes[~alike] = np.fromiter(map(len, apart), np.int64, len(apart))
        out, first = np.zeros(sizes.sum(), np.uint32), np.repeat(alike, sizes)
        out[first], out[~first] = np.delete(ids, marks), np.concatenate([*apart, np.zeros(0, np.uint32)])
        return out, sizes

    def _gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the known stretches at ``places`` one after another, and where each one's end."""
        firsts, lengths = self.ends[places], self.ends[places + 1] - self.ends[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[np.repeat(firsts - ends[:-1], lengths) + np.arange(ends[-1])], ends

    def _places(self, stretches: pa.Array) -> np.ndarray:
        """Numbers of the different stretches in the table of known ones, learning those that are new.

        Where they would be too many, only those met here stay known.
        """
        places = np.asarray(pc.fill_null(pc.index_in(stretches, value_set=self.known), -1)).astype(np.int64)
        new = np.flatnonzero(places < 0)
        if not len(new):
            return places
        if len(self.known) + len(new) > self.remembered:
            met = places >= 0
            self.flat, self.ends = self._gathered(places[met])
            self.known = stretches.filter(pa.array(met))
            places[met] = np.arange(len(self.known))
        fresh = stretches.take(pa.array(new))
        ids, sizes = self._learnt(fresh)
        places[new] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, fresh])
        self.flat = np.concatenate([self.flat, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of each text's."""
        if not self.cuts:
            own = self._direct(texts.to_pylist())
            return (np.concatenate(own) if own else np.zeros(0, np.uint32)), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        odd = np.asarray(pc.match_substring_regex(texts, "\\x1f" if self.drops_space else ODD_SPACES))
        plain = pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts)
        if self.folds:
            plain = pc.ascii_lower(plain)
        # a comma or full stop at a word's end is a token of its own, as is a single line end
        marked = pc.replace_substring_regex(plain, r"(\pL)([,.;:!?][ \n])", "\\1" + CUT + "\\2")
        marked = pc.replace_substring(pc.replace_substring(marked, "\n", CUT + "\n" + CUT), " ", CUT + " ")
        parts = pc.split_pattern(marked, CUT)
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        encoded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        codes = np.asarray(encoded.indices, dtype=np.int64)
        ids, ends = self._gathered(self._places(encoded.dictionary)[codes])
        cuts = ends[offsets - offsets[0]]
        if odd.any():
            whole = iter(self._direct([texts[int(k)].as_py() for k in np.flatnonzero(odd)]))
            own = [next(whole) if o else ids[a:b] for o, a, b in zip(odd, cuts[:-1], cuts[1:])]
            return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        return ids, cuts


_ENCODERS: dict[str, TokenEncoder] = {}


def encoder(path: str) -> TokenEncoder:
    """One encoder a worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenEncoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to every text's ids."""
    return np.insert(ids, offsets[1:], np.uint32(end)), offsets + np.arange(len(offsets))


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
