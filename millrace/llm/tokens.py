"""Token ids of many texts by the tokenizers library, one library call for each distinct piece.

Texts are cut at ASCII white space (and between a letter or digit and a following mark), the distinct pieces of a
batch go through the library once, and numpy puts the ids of each text together. Pieces already seen by this Python
worker are kept, up to a bound. This holds for vocabularies that split on white space and drop it (`cuts_at_space`);
any other, and texts that may hold a special token, go to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
import types

import numpy as np
import pyarrow as pa

from millrace.llm.common import text_buffers
from millrace.llm.hashing import SPACED, word_bounds, word_hashes

#: Distinct pieces that a worker keeps between batches; when full, it starts anew. Results do not depend on it.
KEPT_PIECES = 2_000_000
#: Pieces that one call of the library encodes.
CALL_PIECES = 20_000
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_MARK = np.zeros(256, bool)
_MARK[list(b".,!;:%$&*#")] = True
_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[48:58] = _ASCII_WORD[65:91] = _ASCII_WORD[97:123] = True


def cuts_at_space(spec: dict) -> bool:
    """Whether a text's ids are those of its white-space-separated pieces, one after another: lower-casing, and a
    split that keeps runs of letters, single digits and runs of other marks apart and drops the rest."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    norms = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return first.get("type") == "Split" and first.get("invert") is True and "Lowercase" in norms and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Marks right after an ASCII letter or digit or a Latin-1 letter: a token never spans the two."""
    at = np.flatnonzero(_MARK[raw])
    at = at[at > 1]
    before = raw[at - 1]
    latin = (raw[at - 2] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (before < 0xC0)
    return at[_ASCII_WORD[before] | latin]


class Encoder:
    """ids(texts) -> (flat uint32 ids, ids per text)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            self.by_piece = cuts_at_space(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # For pieces that are lower-case letters only, normalising and splitting change nothing.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._reset()

    def _reset(self) -> None:
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted piece hashes; their entries
        self.first, self.lens, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encode(self, tokenizer, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        flats, lens = [], []
        for lo in range(0, len(pieces), CALL_PIECES):
            part = pieces[lo : lo + CALL_PIECES]
            e = tokenizer.encode(" ".join(part), add_special_tokens=False)
            flats.append(np.array(e.ids, np.uint32))
            ends = np.cumsum(np.fromiter((len(p) + 1 for p in part), np.int64, len(part)))
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(flats[-1]))
            lens.append(np.bincount(np.searchsorted(ends, at, side="right"), minlength=len(part)))
        return flats, lens

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        plain = np.fromiter((_LETTERS.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        cut = int(plain.sum())
        pieces = [pieces[i] for i in order]
        a, b = self._encode(self.plain, pieces[:cut]), self._encode(self.tokenizer, pieces[cut:])
        lens = np.concatenate([np.zeros(0, np.int64), *a[1], *b[1]])
        entry = np.arange(len(self.lens), len(self.lens) + len(pieces))
        self.lens = np.concatenate([self.lens, lens])
        self.first = np.cumsum(self.lens) - self.lens
        self.flat = np.concatenate([self.flat, *a[0], *b[0]])
        keys, number = np.concatenate([self.keys, hashes[order]]), np.concatenate([self.number, entry])
        by = np.argsort(keys, kind="stable")
        self.keys, self.number = keys[by], number[by]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        lens = np.array([len(x.ids) for x in found], np.int64)
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in found)]), lens

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, offs = text_buffers(texts)
        return self.ids_of(raw, offs)

    def ids_of(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blob = None
        if not self.by_piece or (blob := raw.tobytes()).find(b"<|") >= 0:
            blob = raw.tobytes() if blob is None else blob
            return self._whole([blob[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)])
        start, end, doc = word_bounds(raw, offs, SPACED, _cuts(raw))
        if len(start) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        hashes, sample, back = np.unique(word_hashes(raw, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > KEPT_PIECES:
            self._reset()
        at = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != hashes[inside]
        if new.any():
            s, e = start[sample[new]].tolist(), end[sample[new]].tolist()
            self._learn(hashes[new], [blob[a:b].lower().decode("utf-8", "replace") for a, b in zip(s, e, strict=True)])
            at = np.searchsorted(self.keys, hashes)
        which = self.number[at][back]
        lens = self.lens[which]
        ends = np.cumsum(lens)
        flat = self.flat[np.repeat(self.first[which] - (ends - lens), lens) + np.arange(int(ends[-1]))]
        return flat, np.bincount(doc, weights=lens, minlength=len(offs) - 1).astype(np.int64)


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file; kept between tasks of a reused worker."""
    kept = sys.modules.setdefault("_millrace_kept", types.ModuleType("_millrace_kept")).__dict__
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(path)
    return kept["encoder", path]
