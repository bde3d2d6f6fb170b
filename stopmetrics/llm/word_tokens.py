"""Texts to token ids with a tokenizer file of the tokenizers library, as little-endian 32-bit ids."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from operator import add

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core

# Texts of these characters only are cut at white space and lower-cased here: none of them combines with a neighbour,
# changes under Unicode composition, or is white space to one library and not to the other.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿŒœŸ¡¿«»–—‘’“”…€]*")
# Those of them that are neither letters, digits nor white space: a run of them behind a letter or digit is cut off as a
# word of its own.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»–—‘’“”…€"
_LONG = 64
_TEXTS = 512


# How the library cuts texts, in files where a word of letters only, lower-cased and of plain characters, stays whole.
_CUTS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _for_letters(path: str):
    """The library's tokenizer without the steps that leave lower-cased words of letters as they are, or None."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

    with open(path, encoding="utf-8") as file:
        cuts = json.load(file).get("pre_tokenizer") or {}
    if cuts.get("pretokenizers") != _CUTS:
        return None
    found = Tokenizer.from_file(path)
    found.normalizer = None
    found.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    return found


class WordTokenizer:
    """Encodes like the tokenizers library, and keeps the ids of words met before, without the signs behind them.

    It is for tokenizers whose words never reach across white space, nor from a letter or digit to the signs behind it,
    and whose only other normalization is Unicode composition and lower case; any text with an unusual character goes to the library as a whole. So does a text with
    the string of a special token, which is that token as the library finds it, or ordinary text if `specials_as_text`.
    Of the memory the later half goes when it holds more than `memo_limit` of words and runs of signs.
    """

    _loaded: dict[tuple[str, bool], WordTokenizer] = {}

    def __init__(self, path: str, memo_limit: int = 500_000, specials_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = specials_as_text
        self.of_letters = _for_letters(path) or self.library
        added = self.library.get_added_tokens_decoder().values()
        # Lower-cased: a token may be looked for in the text before or after it is normalized.
        self.added = [token.content.lower() for token in added]
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}
        self.memo_limit = memo_limit

    @classmethod
    def of_worker(cls, path: str, specials_as_text: bool = False) -> WordTokenizer:
        """The tokenizer of this Python process, loaded once."""
        key = path, specials_as_text
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, specials_as_text=specials_as_text)
        return cls._loaded[key]

    def _library_ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, many to a text; tokens that end a word tell them apart."""
        found = []
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = np.array(self.of_letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(ends) != len(part):  # a tokenizer without such tokens
                found.extend(self._library_ids(part))
                continue
            raw = ids.tobytes()
            found.extend(raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends))
        return found

    def _learn(self, words: set[str]) -> list[str]:
        """Put new words into memory; returns those that are not to stay there."""
        memo = self.memo
        # Signs behind a letter or digit are a token run of their own.
        parts: set[str] = set()
        ended, cores, signs = [], [], []
        for word in words:
            core = word.rstrip(_SIGNS)
            if core and len(core) < len(word):
                ended.append(word)
                cores.append(core)
                signs.append(word[len(core) :])
            else:
                parts.add(word)
        new = parts.union(cores, signs).difference(memo)
        letters = [part for part in new if part.isalpha()]
        others = [part for part in new if not part.isalpha()]
        memo.update(zip(letters, self._ids_of_letters(letters)))
        memo.update(zip(others, self._library_ids(others)))
        memo.update(zip(ended, map(add, map(memo.__getitem__, cores), map(memo.__getitem__, signs))))
        return ended + [part for part in new if len(part) > _LONG]

    def _group(self, texts: list[str | None]) -> list[bytes]:
        words: list[list[str] | None] = []
        rare: list[str] = []
        for text in texts:
            lowered = text.lower() if text else ""
            if text and (not _PLAIN.fullmatch(text) or any(token in lowered for token in self.added)):
                words.append(None)
                rare.append(text)
            else:
                words.append(lowered.split())
        memo = self.memo
        if len(memo) > self.memo_limit:  # what came first is frequent and stays
            for word in list(memo)[self.memo_limit // 2 :]:
                del memo[word]
        passing = self._learn(set().union(*filter(None, words)).difference(memo))
        whole = iter(self._library_ids(rare))
        ids = [next(whole) if one is None else b"".join(map(memo.__getitem__, one)) for one in words]
        for word in passing:
            memo.pop(word, None)
        return ids

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text, four bytes each; none for a NULL or empty text."""
        listed = list(texts)
        return [ids for at in range(0, len(listed), _TEXTS) for ids in self._group(listed[at : at + _TEXTS])]
