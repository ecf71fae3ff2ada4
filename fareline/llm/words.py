"""Token ids of a tokenizers file by words, the library asked once for each distinct word."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Entries of a generation. Both generations of both caches take some 100 MB, and every Python
#: worker that has packed texts keeps them through the steps that follow.
CACHED_CHUNKS, CACHED_WORDS = 150_000, 60_000
LONGEST_CACHED = 64
#: Characters of texts that are cut together.
BATCH = 1_000_000
#: Stands between the packed ids of chunks. Ids are below 2**24, so it is found nowhere else.
END_MARK = b"\xff\xff\xff\xff"

#: Words as the file's own pattern cuts them, for the characters that PLAIN admits.
_WORDS = re.compile(r"[^\W\d_²³¹¼½¾]+|'(?:s|t|re|ve|m|ll|d)|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")
_WORDS_AND_ENDS = re.compile(f"{_WORDS.pattern}| ")

#: Latin text, general punctuation and currency signs: their normal form is themselves
#: and lower-casing doesn't look at neighbours. Controls that only Python counts as white
#: space are out, as are the marks that start a special token.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-įı-ſ‐-‧₠-₿]*")


class WordIds:
    """Packed ids (32-bit, little-endian) of texts.

    Texts are cut at white space many at a time, and each distinct chunk is looked up once.
    Ids of chunks are cached, as are those of words met only inside chunks, each in two
    generations: when the newer is full it becomes the older, and what is used again moves
    on; long ones aren't kept. Texts with other characters or special tokens go to the library
    whole, as do all texts if the file isn't of the kind whose cuts are known (lower case, white
    space dropped, byte-level words).
    """

    def __init__(self, tokenizer_file: str) -> None:
        # Spark's tasks are the parallelism; threads for a few words cost more than they give.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        sample = "It's 12 MOST_odd ... texts, don't\tyou\nthink?  É½x²y"
        self._chunks: dict[str, bytes] = {}
        self._old_chunks: dict[str, bytes] = {}
        # Words that are cut and lower-cased already need no more than their bytes' symbols,
        # and ASCII ones are their own.
        self._ascii, self._other = Tokenizer(self._tokenizer.model), Tokenizer(self._tokenizer.model)
        self._ascii.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self._other.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._words: dict[str, bytes] = {}
        self._old_words: dict[str, bytes] = {}
        self._by_words = self._packed_by_words([sample]) == [self._whole(sample)]

    def packed(self, text: str) -> bytes:
        return self.packed_all([text])[0]

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; texts of some BATCH characters are cut and looked up together."""
        plain = [self._plain(text) for text in texts]
        by_words = chain.from_iterable(map(self._packed_by_words, _batches(list(compress(texts, plain)))))
        return [next(by_words) if known else self._whole(text) for text, known in zip(texts, plain, strict=True)]

    def _plain(self, text: str) -> bool:
        return self._by_words and bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self._specials)

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _packed_by_words(self, texts: list[str]) -> list[bytes]:
        chunks = pc.utf8_split_whitespace(pa.array([text.lower() for text in texts], pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        packed = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # The ids of the distinct chunks, laid end to end, are taken in the order of the texts' chunks.
        ids, sizes = np.frombuffer(b"".join(packed), "<u4"), np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        order = coded.indices.to_numpy()
        taken = sizes[order]
        ends = np.concatenate(([0], np.cumsum(taken)))
        starts = (np.cumsum(sizes) - sizes)[order]
        made = ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], taken)].tobytes()
        at = (4 * ends[chunks.offsets.to_numpy()]).tolist()
        return [made[start:end] for start, end in pairwise(at)]

    def _looked_up(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of distinct chunks."""
        if len(self._chunks) > CACHED_CHUNKS:
            self._chunks, self._old_chunks = {}, _bounded(self._chunks, CACHED_CHUNKS)
        packed = list(map(self._chunks.get, chunks))
        missed = [chunk for chunk, each in zip(chunks, packed, strict=True) if each is None]
        if not missed:
            return packed
        found = list(map(self._old_chunks.get, missed))
        learnt = iter(self._learnt([chunk for chunk, each in zip(missed, found, strict=True) if each is None]))
        found = [next(learnt) if each is None else each for each in found]
        _keep(self._chunks, missed, found)
        rest = iter(found)
        return [next(rest) if each is None else each for each in packed]

    def _learnt(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of chunks that no cache has, by their words."""
        whole = {chunk for chunk in chunks if chunk.isalpha()}
        parts = _WORDS_AND_ENDS.findall(" ".join([chunk for chunk in chunks if chunk not in whole]))
        if len(self._words) > CACHED_WORDS:
            self._words, self._old_words = {}, _bounded(self._words, CACHED_WORDS)
        known = {" ": END_MARK}
        met = set(parts).difference(known)
        wanted = set(met)
        for cache in (self._chunks, self._old_chunks, self._words, self._old_words):
            if cache is self._words:
                wanted |= whole
            again = cache.keys() & wanted
            known.update(zip(again, map(cache.__getitem__, again), strict=True))
            wanted -= again
        known.update(self._encoded(wanted))
        # A word that is a chunk will be found among the chunks.
        inside = [word for word in met - whole if word in wanted or word in self._old_words]
        _keep(self._words, inside, map(known.__getitem__, inside))
        made = iter(b"".join(map(known.__getitem__, parts)).split(END_MARK))
        return [known[chunk] if chunk in whole else next(made) for chunk in chunks]

    def _encoded(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of each word. One text of all words costs less than a result for each."""
        ascii_ = {word for word in words if word.isascii()}
        encoded = {}
        for tokenizer, some in ((self._ascii, list(ascii_)), (self._other, list(words - ascii_))):
            made = tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ids = np.array(made, dtype="<u4")
            ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
            if len(ends) == len(some):
                packed = ids.tobytes()
                encoded.update(zip(some, [packed[start:end] for start, end in pairwise([0, *ends])], strict=True))
            else:
                encoded.update((word, self._whole(word)) for word in some)
        return encoded


def _keep(cache: dict[str, bytes], chunks: list[str], packed: Iterable[bytes]) -> None:
    cache.update(zip(chunks, packed, strict=True))
    for chunk in chunks:
        if len(chunk) > LONGEST_CACHED:
            cache.pop(chunk, None)


def _batches(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of at most BATCH characters or of one text."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > BATCH:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def _bounded(full: dict[str, bytes], most: int) -> dict[str, bytes]:
    """The full generation as the older one, or none if a single text has filled it far beyond."""
    return full if len(full) <= 2 * most else {}


_LOADED: dict[str, WordIds] = {}


def load_words(tokenizer_file: str) -> WordIds:
    """The ids of a tokenizers file, with its caches, once for each process."""
    if tokenizer_file not in _LOADED:
        _LOADED[tokenizer_file] = WordIds(tokenizer_file)
    return _LOADED[tokenizer_file]
