"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding.

A sequence of tokens is what BPE gives exactly if each neighbouring pair is what BPE
gives for the two tokens' joined text. So every prefix of a text has one last token: the
one token that ends there and is compatible with the last token of the prefix before it.
An Aho-Corasick automaton gives the tokens that end at each place, the table keeps the
compatible one, and the ids are read from it backwards.

Whether a pair is compatible follows from the merges that built its tokens: walking up
the right edge of the left token and the left edge of the right token in the order of
the merges, the two may at no time merge across the border.

No vocabulary piece holds a character before a space mark, or two characters of
different classes, which is checked for the given model. Texts are therefore cut there,
and the encoding of each cut is kept in a cache of bounded size.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import struct

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from fareline.llm.common import map_columns

SPACE = "▁"
_BROKEN = re.compile("[\udc80-\udcff]")
NEVER = float("inf")
CACHE_ENTRIES = 200_000
LONGEST_CACHED = 64

#: Space marks with the letters, digits or others that follow; powers count as others.
_CUTS = re.compile(f"{SPACE}*(?:[^\\W\\d_¹²³]+|\\d+|(?:[^\\w{SPACE}]|[_¹²³])+)|{SPACE}+")


class PieceTable:
    """Vocabulary, merge edges and automaton of one model file."""

    def __init__(self, model_file: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {piece: b for b, piece in enumerate(self.bytes)}
        self.silent = {i for i in range(size) if model.is_control(i) or model.is_unused(i)}
        plain = [
            i for i in range(size) if i not in self.byte_of and i not in self.silent and not model.is_unknown(i)
        ]
        self.text = {i: model.id_to_piece(i) for i in plain}
        self.ids = {text: i for i, text in self.text.items()}
        self.rank = {text: -model.get_score(i) for text, i in self.ids.items()}
        long = [text for text in self.ids if len(text) > 1]
        if any(c not in self.ids for text in long for c in text):
            raise ValueError("a piece holds a character that is no piece of its own")
        whole = all(_CUTS.fullmatch(text) for text in long)
        self._cuts = _CUTS if whole else re.compile("(?s).+")
        self.cut_at_spaces = whole
        self._characters = {text for text in self.ids if len(text) == 1}
        self._edges = {}
        self._automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            edges = self._merge_edges(text)
            if edges:
                self._edges[i] = edges
                self._automaton.add_word(text, (len(text), i))
        self._automaton.make_automaton()
        self._compatible: dict[int, bool] = {}
        self._decoded = [self._surface(i) for i in range(size)]

    def _merge_edges(self, text: str) -> tuple[list, list] | None:
        """Nodes on the left and on the right edge of a piece, each with the rank of the
        merge that takes it in, from the single character up; None if merging the
        characters doesn't end in the piece."""
        parts = list(text)
        left, right = [], []
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                return None
            at = ranks.index(best)
            if at == 0:
                left.append((parts[0], best))
            if at == len(parts) - 2:
                right.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*left, (text, NEVER)], [*right, (text, NEVER)]

    def compatible(self, one: int, two: int) -> bool:
        """Whether BPE keeps the border between two tokens."""
        key = one << 32 | two
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= 4 * CACHE_ENTRIES:
                self._compatible.clear()
            known = self._compatible[key] = self._border_stays(self._edges[one][1], self._edges[two][0])
        return known

    def _border_stays(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = left[i], right[j]
            across = self.rank.get(a + b, NEVER)
            # Of equal ranks the leftmost merges first: the left token's, then the border's.
            if across < a_until and across <= b_until and across < NEVER:
                return False
            if a_until == b_until == NEVER:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text without unknown characters."""
        known = self.ids.get(part)
        if known is not None and known in self._edges:
            return [known]
        last = [-1] * (len(part) + 1)
        compatible, memo = self.compatible, self._compatible
        for end, (length, piece) in self._automaton.iter(part):
            if last[end + 1] < 0:
                start = end + 1 - length
                if start:
                    before = last[start]
                    fits = memo.get(before << 32 | piece)
                    if fits is None:
                        fits = compatible(before, piece)
                    if not fits:
                        continue
                last[end + 1] = piece
        ids, at = [], len(part)
        while at:
            ids.append(last[at])
            at -= len(self.text[last[at]])
        ids.reverse()
        return ids

    def encode_marked(self, text: str) -> list[int]:
        """Ids of a text with space marks; characters without a piece become bytes."""
        if self._characters.issuperset(text):
            return self.encode_part(text)
        ids = []
        for known, run in itertools.groupby(text, self._characters.__contains__):
            part = "".join(run)
            ids += self.encode_part(part) if known else [self.bytes[b] for b in part.encode()]
        return ids

    def cut(self, text: str) -> list[str]:
        return self._cuts.findall(text)

    def _surface(self, piece: int) -> bytes:
        if piece in self.byte_of:
            return bytes([self.byte_of[piece]])
        if piece == self.unknown:
            return " ⁇ ".encode()
        return self.text.get(piece, "").replace(SPACE, " ").encode()

    def decode(self, packed: bytes) -> bytes:
        """UTF-8 of the ids (32-bit, little-endian): space marks become spaces, the first
        one goes, runs of byte pieces are read as UTF-8 with a replacement character for
        each byte that isn't."""
        ids = struct.unpack(f"<{len(packed) // 4}I", packed)
        decoded = self._decoded
        joined = b"".join([decoded[i] for i in ids])
        try:
            joined.decode()
        except UnicodeDecodeError:
            joined = b"".join(
                _BROKEN.sub("\ufffd", bytes(map(self.byte_of.get, run)).decode(errors="surrogateescape")).encode()
                if is_byte
                else b"".join(decoded[i] for i in run)
                for is_byte, run in itertools.groupby(ids, self.byte_of.__contains__)
            )
        first = next((i for i in ids if i not in self.silent), None)
        starts_marked = first is not None and self.text.get(first, "").startswith(SPACE)
        return joined[1:] if starts_marked else joined


class Encoder:
    """Packed ids of texts by chunks, each a space mark and what follows up to the next.

    Chunks and their cuts are cached in two generations: when the newer is full it becomes
    the older, and what is used again moves on, so common words stay.
    """

    def __init__(self, table: PieceTable) -> None:
        self.table = table
        self._chunks: dict[str, bytes] = {}
        self._old_chunks: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._old_parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a text without begin and end, packed as 32-bit integers."""
        if not text:
            return b""
        if not self.table.cut_at_spaces or text[0] == " " or "  " in text or SPACE in text:
            return self._packed(SPACE + text.replace(" ", SPACE))
        chunks = text.split(" ")
        new = set(chunks).difference(self._chunks)
        if new and len(self._chunks) > CACHE_ENTRIES:
            self._chunks, self._old_chunks = {}, self._chunks
            new = set(chunks)
        known, old = self._chunks, self._old_chunks
        for chunk in new:
            known[chunk] = old.get(chunk) or self._packed(SPACE + chunk)
        packed = b"".join(map(known.__getitem__, chunks))
        for chunk in new:
            if len(chunk) > LONGEST_CACHED:
                del known[chunk]
        return packed

    def _packed(self, marked: str) -> bytes:
        if len(self._parts) > CACHE_ENTRIES:
            self._parts, self._old_parts = {}, self._parts
        found = []
        for part in self.table.cut(marked):
            packed = self._parts.get(part)
            if packed is None:
                packed = self._old_parts.get(part)
                if packed is None:
                    ids = self.table.encode_marked(part)
                    packed = struct.pack(f"<{len(ids)}I", *ids)
                if len(part) <= LONGEST_CACHED:
                    self._parts[part] = packed
            found.append(packed)
        return found[0] if len(found) == 1 else b"".join(found)


_ENCODERS: dict[str, Encoder] = {}


def load_encoder(model_file: str) -> Encoder:
    """The encoder of a model file, once for each process."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = Encoder(PieceTable(model_file))
    return _ENCODERS[model_file]


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the ids of its text, begin and end included, and the text decoded.

    Returns id_col, ids (packed little-endian unsigned 32-bit integers), n_tokens and
    decoded (UTF-8 text). A null text counts as empty: begin and end ids, an empty text.
    Rows are independent; repeated rows give repeated results and other columns are not
    read. The model file must be there on every executor.
    """
    kind = docs.select(id_col).dtypes[0][1]

    def make():
        encoder = load_encoder(model_file)
        table = encoder.table
        begin, end = struct.pack("<I", table.begin), struct.pack("<I", table.end)

        def work(keys: list, texts: list) -> list[list]:
            ids = [begin + encoder.encode(text or "") + end for text in texts]
            return [keys, ids, [len(x) // 4 for x in ids], [table.decode(x).decode() for x in ids]]

        return work

    schema = f"doc_id {kind}, ids binary, n_tokens long, decoded string"
    return map_columns(docs, [id_col, text_col], schema, make).withColumnRenamed("doc_id", id_col)


def encode_digest(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode_decode with SHA-256 digests taken where the ids are made.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256. Ids and texts don't leave the
    Python worker, which saves carrying twice the size of the corpus to the JVM.
    """
    kind = docs.select(id_col).dtypes[0][1]

    def make():
        encoder = load_encoder(model_file)
        table = encoder.table
        begin, end = struct.pack("<I", table.begin), struct.pack("<I", table.end)

        def work(keys: list, texts: list) -> list[list]:
            counts, ids_sha, text_sha = [], [], []
            for text in texts:
                ids = begin + encoder.encode(text or "") + end
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(table.decode(ids)).hexdigest())
            return [keys, counts, ids_sha, text_sha]

        return work

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs, [id_col, text_col], schema, make).withColumnRenamed("doc_id", id_col)
