"""Token ids of whole texts by a ``tokenizers`` file whose pre-tokenizer drops white space.

Such a tokenizer (a word-level BPE) treats the text between two runs of white
space on its own, so each distinct stretch goes to the library once per worker
and later ones are looked up.  ``IDS`` are kept as little-endian 32-bit bytes:
joining them gives a text's ids with no per-token Python work.
"""

from __future__ import annotations

import re
from functools import lru_cache

#: Entries that a worker keeps; beyond them the older half of its words is forgotten.
MEMO_WORDS = 1_000_000
#: Longer stretches aren't kept.
MEMO_BYTES = 48

#: Letters and then ASCII signs, without the apostrophe and "<|": two pre-tokens.
_SIGNS = re.compile(r"[^\W\d_]+[!-&(-/:;=>?@\[-`{}~]+")


class WordTokens:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.ends = None
        self._single_words()

    def _single_words(self) -> None:
        """Ids that end a word, if the vocabulary marks word ends: many words can then go in one call."""
        import numpy as np

        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        if sum(t.endswith("</w>") for t in vocab) > 256:
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _together(self, words: list[str], parts: int) -> dict[bytes, bytes]:
        """Ids of words that have at least ``parts`` pre-tokens each, many in a call.

        If the ids of a call hold exactly ``parts`` word ends for each word, the
        ends tell the words apart; a call that doesn't is left to the caller.
        """
        import numpy as np

        found: dict[bytes, bytes] = {}
        calls = [words[i:i + 500] for i in range(0, len(words), 500)]
        for call, e in zip(calls, self.tokenizer.encode_batch_fast([" ".join(c) for c in calls], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == parts * len(call):
                raw, cuts = ids.tobytes(), (cuts[parts - 1::parts] * 4).tolist()
                found.update(zip(map(str.encode, call), map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts)), strict=True))
        return found

    def _library(self, words: list[bytes]) -> list[bytes]:
        import numpy as np

        found: dict[bytes, bytes] = {}
        if self.ends is not None:
            texts = [w.decode() for w in words]
            found |= self._together([t for t in texts if t.isalpha()], 1)
            found |= self._together([t for t in texts if _SIGNS.fullmatch(t)], 2)
        rest = [w for w in words if w not in found]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
            found[w] = np.array(e.ids, "<u4").tobytes()
        return [found[w] for w in words]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, from the memo or else from the library."""
        if len(self.young) > MEMO_WORDS // 2:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        if None in found:
            missing = [k for k, i in enumerate(found) if i is None]
            for k in missing:
                found[k] = self.old.get(words[k])
            unknown = [k for k in missing if found[k] is None]
            for k, i in zip(unknown, self._library([words[k] for k in unknown]), strict=True):
                found[k] = i
            self.young.update((words[k], found[k]) for k in missing if len(words[k]) <= MEMO_BYTES)
        return found

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text, as the library gives them without added tokens."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # lower case as the tokenizer does it anyway, but a special token's string must be seen as written
        cased = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.large_binary()).cast(pa.large_string())
        split = pc.ascii_split_whitespace(cased)
        words = split.values.dictionary_encode()
        found = self._known(words.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        count = sizes[at]
        ends = np.cumsum(count)
        ids = flat[np.repeat(starts[at] - ends + count, count) + np.arange(count.sum())].tobytes()
        cuts = (np.append(0, ends)[split.offsets.to_numpy()] * 4).tolist()
        return [ids[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a worker process, whose memo serves all the tasks that it runs."""
    return WordTokens(path)
