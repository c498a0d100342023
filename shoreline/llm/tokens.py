"""Whole texts to token ids, by caching the ids of white-space separated chunks.

The vocabulary file's normaliser and word pattern never join across ASCII white
space, so a text's ids are the ids of its chunks in order.  A worker keeps the ids of
the chunks it has met (bounded) and encodes only new ones.  New chunks of plain
letters, digits and marks go through a byte-pair table built from the same vocabulary,
where ids and merge ranks coincide; all others go through the tokenizer itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Chunks whose ids one worker remembers; beyond it the memory starts anew.
CACHE_CHUNKS = 500_000
DEFAULT_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """``encode(text)`` -> little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, vocabulary: str, cache: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(vocabulary)
        self.cache: dict[bytes, bytes] = {}
        self.limit = cache
        self.fast = self._byte_pairs(json.loads(vocabulary))

    def _byte_pairs(self, spec):
        """A byte-pair encoder with the vocabulary's ranks, if it marks word ends and
        numbers its tokens in merge order; else None."""
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>":
            return None
        import tiktoken

        # printable stand-ins of bytes, as byte-level vocabularies write them
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {}
        for token, i in model["vocab"].items():
            end = token.endswith("</w>")
            body = token[:-4] if end else token
            if any(c not in byte_of for c in body):
                continue  # a special token
            ranks[bytes(byte_of[c] for c in body) + b"\x00" * end] = i
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = all(model["vocab"].get(a + b) == 512 + k for k, (a, b) in enumerate(merges))
        if not in_order:
            return None
        self.words = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")
        self.line = ranks[b"\n\x00"]
        # ASCII without NUL, and the letters of Latin-1 that have a one-character lower case
        self.safe = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
        return tiktoken.Encoding("chunks", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})

    def _fill(self, chunks) -> None:
        texts = {c.decode("utf-8", "surrogatepass"): c for c in chunks}
        quick = []
        if self.fast is not None:
            safe = self.safe.fullmatch
            quick = [t for t in texts if safe(t) and "<|" not in t]
        if quick:
            words = self.words.findall("\n".join(quick).lower())
            ids = np.asarray(self.fast.encode_ordinary("\x00".join(words) + "\x00"), "<u4")
            lines = np.flatnonzero(ids == self.line)
            start = (np.concatenate([[0], lines + 1]) * 4).tolist()
            stop = (np.concatenate([lines, [len(ids)]]) * 4).tolist()
            raw = ids.tobytes()
            self.cache.update((texts.pop(t), raw[a:b]) for t, a, b in zip(quick, start, stop, strict=True))
        if texts:
            got = self.slow.encode_batch(list(texts), add_special_tokens=False)
            for c, e in zip(texts.values(), got, strict=True):
                self.cache[c] = np.asarray(e.ids, "<u4").tobytes()

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for at in range(0, len(texts), 500):
            split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts[at:at + 500]]
            new = set().union(*split).difference(self.cache)
            if len(self.cache) + len(new) > self.limit:
                self.cache.clear()
                new = set().union(*split)
            self._fill(new)
            get = self.cache.__getitem__
            out += [b"".join(map(get, s)) for s in split]
        return out
