"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary."""

from __future__ import annotations

import codecs
import re
import sys
import types
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, with_column_replaced
from .packing import vocabulary_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Strings whose ids a worker remembers, and their longest length.
REMEMBERED, REMEMBERED_CHARS = 800_000, 48
#: Bytes of texts handled together inside an Arrow batch (a longer text alone).
AT_ONCE_BYTES = 2 << 20
#: Stands for the rank of a pair that makes no piece.
NO_PIECE = 1 << 60

#: The letters of a string with the space marks before them, and what is between them.
_SIDES = re.compile(SPACE + r"*[^\W\d_]+|(?:[\W\d_](?<!" + SPACE + "))+|" + SPACE + "+")

codecs.register_error("kitchenlens-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """Ids of texts and texts of ids, for one model file.

    Encoding starts from single characters.  An agenda holds the adjacent pairs of symbols that make a
    piece, best score first and leftmost first among equals; the best pair is merged, and its new
    neighbourhoods enter the agenda, until no pair is left.  A character that is no piece becomes its bytes.

    No merge can span two neighbouring characters that stand next to each other in no piece, so a text
    falls into strings at those places that are merged apart, and the ids of short strings are remembered.
    Where no piece has the space mark after another character, these strings are the words with the marks
    before them.  The strings that a batch brings anew are encoded by the library too; a string on which the two
    differ takes the library's ids and is kept in ``differing``."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE:
            raise ValueError(f"{path} is no merge-type vocabulary")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError(f"{path} has user-defined or unused pieces, or marks spaces at the ends of words")
        rules = proto.normalizer_spec
        #: prefix and mapping of spaces only: else the library normalises each text
        self.plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.strips = rules.add_dummy_prefix or rules.remove_extra_whitespaces
        self.strips_all = rules.remove_extra_whitespaces
        self.unknown = self.library.unk_id()
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        scores = {p.piece: p.score for p in proto.pieces if p.type == kind.NORMAL}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in scores.items()}      # 0 is the best score
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.words_apart = not any(p[1] == SPACE and p[0] != SPACE for p in self.pairs)
        self.control = {i for i, p in enumerate(proto.pieces) if p.type == kind.CONTROL}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if proto.trainer_spec.byte_fallback else None
        texts = [p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        for i in self.control:
            texts[i] = b""
        texts[self.unknown] = proto.trainer_spec.unk_surface.encode()
        for b, i in enumerate(self.bytes or []):
            texts[i] = bytes([b])
        self.texts = texts
        self.starts_with_space = {i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL and p.piece.startswith(SPACE)}
        self.known: dict[str, bytes] = {}       # the young half of what is remembered; what is met again stays
        self.old: dict[str, bytes] = {}
        self.differing: set[str] = set()

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return self.prefix + text.replace(" ", SPACE) if self.plain else self.library.normalize(text)

    def strings(self, normal: str) -> list[str]:
        """A normalised text cut where no piece can span."""
        if not self.words_apart:
            return self._apart(normal)
        words = normal.split(SPACE)
        if words[0]:
            return [words[0], *self.strings(normal[len(words[0]):])] if len(words) > 1 else words
        del words[0]
        if "" not in words:
            return [SPACE + w for w in words]
        return re.findall(SPACE + "+[^" + SPACE + "]*", normal)

    def _apart(self, string: str) -> list[str]:
        """``string`` cut between characters that are neighbours in no piece: a short one between letters and other characters, a
        long one wherever it can be."""
        pairs = self.pairs
        if len(string) > REMEMBERED_CHARS:
            cuts = [i for i, pair in enumerate(map(add, string, string[1:]), 1) if pair not in pairs]
            return [string[x:y] for x, y in zip([0, *cuts], [*cuts, len(string)])] if cuts else [string]
        if string[1:].isalpha():
            return [string]
        out = [""]
        for part in _SIDES.findall(string):
            if out[-1] and out[-1][-1] + part[0] in pairs:
                out[-1] += part
            else:
                out.append(part)
        return out[1:]

    def merge(self, string: str) -> list[str]:
        """The pieces of a string: adjacent pairs merged by falling score, the leftmost first among equals."""
        piece, ranks, n = list(string), self.ranks.get, len(string)
        if n <= REMEMBERED_CHARS:       # few pairs: the agenda is the list of their ranks, in the symbols' order
            agenda = [ranks(pair, NO_PIECE) for pair in map(add, string, string[1:])]
            while agenda and (best := min(agenda)) != NO_PIECE:
                left = agenda.index(best)
                both = piece[left] + piece[left + 1]
                piece[left] = both
                del piece[left + 1], agenda[left]
                if left < len(agenda):
                    agenda[left] = ranks(both + piece[left + 1], NO_PIECE)
                if left:
                    agenda[left - 1] = ranks(piece[left - 1] + both, NO_PIECE)
            return piece
        bits = n.bit_length()
        mask = (1 << bits) - 1
        # an entry is the rank and, in its last bits, the place of the left symbol: the smallest is the best score's leftmost pair
        agenda = [rank << bits | i for i, rank in enumerate(map(ranks, map(add, string, string[1:]))) if rank is not None]
        if not agenda:
            return piece
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(agenda)
        while agenda:
            best = heappop(agenda)
            left = best & mask
            right = after[left]
            if right == n or not piece[left] or ranks(both := piece[left] + piece[right]) != best >> bits:
                continue        # one of the two was merged with another symbol since
            piece[left], piece[right] = both, ""
            follow, ahead = after[right], before[left]
            after[left] = follow
            if follow < n:
                before[follow] = left
                if (rank := ranks(both + piece[follow])) is not None:
                    heappush(agenda, rank << bits | left)
            if ahead >= 0 and (rank := ranks(piece[ahead] + both)) is not None:
                heappush(agenda, rank << bits | ahead)
        return [p for p in piece if p]

    def _ids(self, pieces: list[str]) -> bytes:
        out = list(map(self.ids.get, pieces))
        if None not in out:
            return array("I", out).tobytes()
        out.clear()
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes is not None:
                out += [self.bytes[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return array("I", out).tobytes()

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of new strings, by the agenda, then compared with the library's.  Parts of strings are remembered among the strings, where
        the comparison found no difference."""
        known, old, learned, parts, differing = self.known, self.old, {}, {}, len(self.differing)
        for string in new:
            apart = self._apart(string)
            if len(apart) == 1:
                learned[string] = self._ids(self.merge(string))
                continue
            found = []
            for part in apart:
                ids = known.get(part) or old.get(part) or parts.get(part)
                if ids is None:
                    ids = parts[part] = self._ids(self.merge(part))
                found.append(ids)
            learned[string] = b"".join(found)
        self._check(learned)
        if len(self.differing) == differing:
            known.update((p, i) for p, i in parts.items() if len(p) <= REMEMBERED_CHARS)
        return learned

    def _check(self, learned: dict[str, bytes]) -> None:
        """One call of the library for all new strings in a row, and one for each string should that differ."""
        strings = [s for s in learned if s.startswith(SPACE)] if self.plain and self.prefix else []
        whole = "".join(strings)
        if len(whole) > 1 and self._library(whole) != b"".join([learned[s] for s in strings]):
            for s in strings:
                if len(s) > 1 and (right := self._library(s)) != learned[s]:
                    learned[s] = right
                    self.differing.add(s)

    def _library(self, normal: str) -> bytes:
        """The library's ids of the text whose normalised form is ``normal`` (its first mark is the prefix)."""
        return np.array(self.library.encode(normal[1:].replace(SPACE, " ")), "<u4").tobytes()

    def _look_up(self, strings: list[str]) -> list[bytes]:
        """Ids of distinct strings, remembered or learned."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        found = list(map(known.get, strings))
        for i, ids in enumerate(found):
            if ids is None and (ids := old.get(strings[i])) is not None:
                found[i] = known[strings[i]] = ids
        missing = [i for i, ids in enumerate(found) if ids is None]
        learned = self._learn([strings[i] for i in missing])
        for i in missing:
            found[i] = learned[strings[i]]
        known.update((s, i) for s, i in learned.items() if len(s) <= REMEMBERED_CHARS)
        return found

    def _one_by_one(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bool]]:
        rows = [self.strings(n) if (n := self.normalise(t or "")) else [] for t in texts]
        distinct = list(set().union(*rows))
        now = dict(zip(distinct, self._look_up(distinct)))
        return [np.frombuffer(b"".join([now[s] for s in row]), "<u4") for row in rows], [self.differing.isdisjoint(row) for row in rows]

    def encode(self, texts: pa.Array | list) -> tuple[list[np.ndarray], list[bool]]:
        """The ids of each text (null: none), and whether the library gave the same for all of its strings.

        Texts whose words all have one space before them are split by Arrow, which hands on each batch's distinct words only."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))      # kernels read a slice's neighbours
        plain = self.plain and self.prefix and self.words_apart
        odd = pc.match_substring_regex(texts, "(^| )( |$)|" + SPACE) if plain else pa.array([True] * len(texts), pa.bool_())
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        even = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        ids, agrees = [None] * len(texts), [True] * len(texts)
        if len(at):
            for i, found, same in zip(at.tolist(), *self._one_by_one(texts.take(pa.array(at)).to_pylist())):
                ids[i], agrees[i] = found, same
        if len(even):
            lists = pc.split_pattern(texts.take(pa.array(even)), " ")
            coded = lists.flatten().dictionary_encode()
            words, which = [SPACE + w for w in coded.dictionary.to_pylist()], coded.indices.to_numpy()
            pieces = self._look_up(words)
            length = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
            first = np.concatenate([[0], np.cumsum(length)])
            n = length[which]
            before = np.concatenate([[0], np.cumsum(n)])
            flat = np.frombuffer(b"".join(pieces), "<u4")[np.repeat(first[which] - before[:-1], n) + np.arange(before[-1])]
            places = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            wrong = np.fromiter((w in self.differing for w in words), bool, len(words))[which] if self.differing else None
            for i, x, y in zip(even.tolist(), places, places[1:]):
                ids[i] = flat[before[x]:before[y]]
                agrees[i] = wrong is None or not wrong[x:y].any()
        if self.bytes is None:      # neighbouring unknown characters are one unknown piece
            ids = [i[np.concatenate([[True], (i[1:] != self.unknown) | (i[:-1] != self.unknown)])] if len(i) else i for i in ids]
        return ids, agrees

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces in a row with spaces for their marks, bytes read as UTF-8 (a byte that is no part of a
        character gives U+FFFD), control pieces nothing, without the space that encoding puts first."""
        first = next((i for i in ids if i not in self.control), None)
        data = b"".join([self.texts[i] for i in ids])
        drop = 0 if not self.strips or first not in self.starts_with_space else len(data) - len(data.lstrip(b" ")) if self.strips_all else 1
        if self.control.isdisjoint(ids):
            return data[drop:].decode("utf-8", "kitchenlens-each-byte")
        runs: list[list[bytes]] = [[]]      # a control piece ends a run of bytes
        for i in ids:
            runs.append([]) if i in self.control else runs[-1].append(self.texts[i])
        return "".join([b"".join(r).decode("utf-8", "kitchenlens-each-byte") for r in runs])[drop:]


def byte_slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The rows of a string column in slices of at most ``most`` bytes, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def _model(path: str) -> PieceModel:
    """One model for each file and worker process."""
    kept = sys.modules.setdefault("_kitchenlens_pieces", types.ModuleType("_kitchenlens_pieces")).__dict__
    if path not in kept:
        kept[path] = PieceModel(path)
    return kept[path]


PIECES = "struct<ids:array<int>,decoded:string,agrees:boolean>"
_PIECES = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("agrees", pa.bool_())])


def with_pieces(docs: DataFrame, out_col: str = "pieces", text_col: str = "text", model: str = MODEL,
                check_texts: bool = False) -> DataFrame:
    """``docs`` with struct ``out_col``: ``ids`` of the whole text, the text ``decoded`` from them, and ``agrees``.

    ``agrees`` is false where the sentencepiece library gives other ids for a string of the text, or another
    text for the ids; the library's results stand then.  Each batch's new strings and all decoded texts are
    compared; ``check_texts`` encodes every whole text with the library as well.  ``model`` is a public
    model's name or a path.  Null and empty texts have no ids and decode to the empty text.  Repeated
    rows come back repeated; an input column named ``out_col`` is replaced; an empty table stays empty."""
    @F.arrow_udf(PIECES)
    def pieces(texts: pa.Array) -> pa.Array:
        coder, parts = _model(vocabulary_path(model)), []
        for rows in byte_slices(texts, AT_ONCE_BYTES):
            ids, agrees = coder.encode(rows)
            lists = [i.tolist() for i in ids]
            if check_texts:
                for k, right in enumerate(coder.library.encode([t or "" for t in rows.to_pylist()], num_threads=1)):
                    if right != lists[k]:
                        lists[k], ids[k], agrees[k] = right, np.array(right, "<u4"), False
            decoded = [coder.decode(i) for i in lists]
            for k, right in enumerate(coder.library.decode(lists, num_threads=1)):
                if right != decoded[k]:
                    decoded[k], agrees[k] = right, False
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            parts.append(pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                fields=list(_PIECES)))
        return pa.concat_arrays(parts) if parts else pa.array([], _PIECES)
    return with_column_replaced(docs, out_col, pieces(F.col(f"`{text_col}`")))


def op12_pieces(spark, sf_dir: str) -> DataFrame:
    """Every document's ids and the text decoded from them, as digests."""
    found = with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.col("pieces.ids")
    return found.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256"), F.col("pieces.agrees").alias("agrees"))
