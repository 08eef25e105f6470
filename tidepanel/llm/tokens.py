"""Token ids by a public tokenizer file, one encoding per distinct word where the file allows it."""

from __future__ import annotations

import json
import os

import numpy as np

_open: dict[str, TokenIds] = {}


def splits_words(file: dict) -> bool:
    """True if a tokenizer file lower-cases, and drops white space before its vocabulary sees it."""
    steps = lambda part, inner: [] if not part else [s for p in part.get(inner, [part]) for s in ([p] if inner not in p else steps(p, inner))]
    lowers = any(s["type"] == "Lowercase" for s in steps(file.get("normalizer"), "normalizers"))
    drops = any(
        s["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
        or (s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and "\\s" in json.dumps(s["pattern"]))
        for s in steps(file.get("pre_tokenizer"), "pretokenizers")
    )
    marks = file.get("model", {}).get("continuing_subword_prefix") is not None
    return lowers and drops and not marks


class TokenIds:
    """Encodes texts, by words if the tokenizer treats white-space-separated words on their own.

    That holds for vocabularies that ignore case and whose pre-tokenizer drops white space
    (``word_bpe_49k``): the ids of a text are those of its words in order, so each distinct word
    is encoded once per worker and very long texts need no more memory than their ids.
    ``memo_words`` bounds the memory of the memo; it is emptied when full, which changes nothing
    but time. By the file's own normaliser and pre-tokenizer all others encode whole texts.
    """

    def __init__(self, path: str, memo_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = splits_words(json.loads(self.tokenizer.to_str()))
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.memo: dict[bytes, bytes] = {}
        self.memo_words = memo_words

    @classmethod
    def at(cls, path: str) -> TokenIds:
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    def raw(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``."""
        if not self.by_words:
            found = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            return [np.array(f.ids, self.dtype).tobytes() for f in found]
        split = []
        for text in texts:
            data = (text or "").encode()
            # Case does not matter to the vocabulary, except in the names of special tokens.
            split.append((data if b"<|" in data else data.lower()).split())
        out, known = [], self.memo.__getitem__
        for k, ws in enumerate(split):
            try:
                out.append(b"".join(map(known, ws)))
            except KeyError:
                # Words are looked for one by one only in batches that hold a new one.
                self._meet(split[k:])
                out.append(b"".join(map(known, ws)))
        return out

    def _meet(self, split: list[list[bytes]]) -> None:
        """After this the memo has all words of these texts."""
        memo = self.memo
        new = list({w for ws in split for w in ws if w not in memo})
        if len(memo) + len(new) > self.memo_words:
            memo.clear()
            new = list({w for ws in split for w in ws})
        step = 200_000
        for at in range(0, len(new), step):
            self._learn(new[at : at + step])

    def _learn(self, new: list[bytes]) -> None:
        strings = [w.decode() for w in new]
        found = self.tokenizer.encode(" ".join(strings), add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        begins = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        starts = np.cumsum([0] + [len(w) + 1 for w in strings])
        cuts = (np.searchsorted(begins, starts) * ids.itemsize).tolist()
        raw = ids.tobytes()
        for word, a, b in zip(new, cuts, cuts[1:]):
            self.memo[word] = raw[a:b]

    def with_end(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        end = np.array([end_id], self.dtype).tobytes()
        return [np.frombuffer(r + end, self.dtype) for r in self.raw(texts)]
