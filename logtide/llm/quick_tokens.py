"""Token ids for the operators that only need them as input.

`bpe` encodes by its own method. Here a library does it: the vocabulary file is handed
to `tiktoken`, four times as fast on such texts as `tokenizers` and with equal ids,
which the tests compare.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable
from functools import lru_cache

import tiktoken

from logtide.llm.bpe import PIECES, Vocabulary


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], bytes]:
    """Whole text to packed 32-bit ids. The vocabulary's ids must follow its merges."""
    table = Vocabulary(path)
    ranks = {text: number for number, text in table.ordinary.items()}
    inner = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    special, cut = table.special, table.cut

    def ordinary(text: str) -> bytes:
        return inner.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def encode(text: str) -> bytes:
        if not any(name in text for name in special):
            return ordinary(text)
        parts = cut.split(text)
        return b"".join(array("I", [special[x]]).tobytes() if x in special else ordinary(x) for x in parts)

    return encode
