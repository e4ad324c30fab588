"""Alignment of two tokenizations of the same bytes, with corpus-wide counts of linked ids.

Both tokenizers see the text with a space before it. An A and a B token are linked where their
byte ranges overlap. A text is cut into units that no token of either leaves, so a unit's
links are worked out once a task, and a text's are those of its units.

Counts: the first pass writes, for every split of the input, its distinct pairs of ids
with their counts, dealt into buckets by B id. The distinct pairs of a bucket are united up a tree
of splits, and a minimal perfect hash is built from them. Counts become dense vectors
in hash order, one for some splits, which are summed up the tree; beside the sums lie
the pairs themselves, against which every lookup is verified, and the highest count of each B id, whose
pairs share a bucket. Each split then asks the buckets for its pairs, and the second
pass aligns the texts of the split again, with the answers beside them.

A bucket holds at most the A ids times its share of the B ids, whatever the corpus; a split
holds about ``SPLIT_BYTES`` of text. Nothing passes through the driver.

Defined results: NULL and empty texts, and those whose tokens' bytes differ from the text's (texts
that hold U+2581), have no tokens: zeros and ''. Strings of special tokens in a text are text. Repeated
rows repeat and count as often. An empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, Workspace, keyed_rows, tasks_for
from .perfect_hash import PerfectHash
from .trie_bpe import byte_alphabet
from .units import Grown, Numbers, cut, plainly_spaced
from .words import mix

#: Bytes of text of a split, on average; splits a step of the tree takes together; buckets at most.
SPLIT_BYTES, FAN, MOST_BUCKETS = 16_000_000, 64, 4096
#: Unit numbers a task collects before it counts them.
COUNT_UNITS = 4_000_000

_B_BITS = np.int64(32)
#: The white space that units are cut before; bytes beyond which a unit is encoded by itself.
_SPACES, _LONG = b" \t\n\x0b\x0c", 1000
_NEVER = 1 << 40
#: Units encoded in one call; characters of texts whose units are looked up together.
_TOGETHER, _CHUNK = 2000, 500_000
#: The words of byte-level vocabularies.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")
_PARTS = "split long, bucket int, keys binary, counts binary"


class Tokenizers:
    """The two tokenizers: ids of units, and the bytes of ids."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a, self._b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self._a.encode_special_tokens = True
        alphabet = byte_alphabet()
        # None: an id that no text has.
        self.a_bytes: list[bytes | None] = [None] * self._a.get_vocab_size()
        for token, number in self._a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[number] = bytes(alphabet[c] for c in token)
        self.b_bytes, self.cuttable = [], True
        for number in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(number)
            if self._b.is_byte(number):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            elif self._b.is_control(number) or self._b.is_unknown(number):
                self.b_bytes.append(None)
            else:
                plain = piece.replace("▁", " ")
                self.b_bytes.append(plain.encode())
                # Units are cut before a space, tab or line end that follows something else.
                self.cuttable &= len(plain) == 1 or re.search("[^ ] |[\t\n\x0b\x0c]", plain) is None
        self._space = self._b.piece_to_id("▁")
        self._ascii = self._by_ranks(a_path)

    def _by_ranks(self, a_path: str):
        """The same encoding by the ranks of tokens, which is faster, for texts whose letters and digits all
        libraries agree on; None if ids don't follow the order of the merges."""
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        made = [m.replace(" ", "") if isinstance(m, str) else m[0] + m[1] for m in merges]
        ids = self._a.get_vocab(with_added_tokens=False)
        if [ids[token] for token in made] != list(range(256, 256 + len(made))):
            return None
        return tiktoken.Encoding("ranks", pat_str=_WORD, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for i in ids.values()}).encode_ordinary

    def a_ids(self, text: str) -> list[int]:
        if self._ascii is not None and text.isascii():
            return self._ascii(text)
        return self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def b_ids(self, text: str) -> list[int]:
        """The library puts a space before what it is given: it stands for the text's own first space, or goes."""
        if text == " ":
            return [self._space]
        ids = self._b.encode(text[1:] if text[0] == " " else text, num_threads=1)
        return ids if text[0] == " " else ids[1:]


class Aligner:
    """Links of units, worked out once as long as the table of units has room."""

    def __init__(self, a_path: str, b_path: str, spells: bool):
        """``spells``: keep the groups of units as text."""
        self.tokenizers, self._spells = Tokenizers(a_path, b_path), spells
        self._a_sizes, self._b_sizes = (
            np.array([_NEVER if token is None else len(token) for token in tokens], np.int64)
            for tokens in (self.tokenizers.a_bytes, self.tokenizers.b_bytes))
        self._width = max(len(self._a_sizes), len(self._b_sizes))
        #: Ids as written, before a comma, a bar and a semicolon.
        self._written = [f"{k}{mark}" for mark in ",|;" for k in range(self._width)]
        self._written_sizes = np.fromiter(map(len, self._written), np.int64, len(self._written))
        self._numbers = Numbers(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.n_a, self.n_b, self.n_groups, self.link_ends = (Grown(np.int64) for _ in range(4))
        self.keys, self.bad, self.spelled = Grown(np.int64), Grown(bool), []
        self.link_ends.add([0])

    def full(self) -> bool:
        return self._numbers.full()

    def start_afresh(self) -> None:
        self._numbers.clear()

    def units_of(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Numbers of the units of each text; None for a text without tokens."""
        units, ends = [], []
        for text in texts:
            if text:
                data = b" " + text.encode()
                if self.tokenizers.cuttable and plainly_spaced(data):
                    for part in cut(data):
                        units += part
                else:
                    units.append(data)
            ends.append(len(units))
        numbers = self._numbers.of(units)
        bad = np.append(0, np.cumsum(self.bad.all()[numbers]))
        return [None if x == y or bad[y] > bad[x] else numbers[x:y] for x, y in zip([0, *ends[:-1]], ends)]

    def _encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B; None if the bytes of B differ from the text's."""
        told, size = text.decode(), len(text)
        # Tokens stand for bytes of the text, but for U+2581, which B takes for a space, and ids of no text.
        if "▁" in told:
            return None
        a, b = (np.array(ids, np.int64) for ids in (self.tokenizers.a_ids(told), self.tokenizers.b_ids(told)))
        return (a, b) if self._a_sizes[a].sum() == size == self._b_sizes[b].sum() else None

    def _learn(self, units: list[bytes]) -> None:
        # Units that begin with white space and end without stay apart when they are put together.
        order, found, plain = [], [], {True: [], False: []}
        apart = []
        for k, u in enumerate(units):
            if u[0] not in _SPACES or u[-1] in _SPACES or len(u) > _LONG:
                apart.append(k)
            else:
                plain[u.isascii()].append(k)
        for numbers in plain.values():
            for x in range(0, len(numbers), _TOGETHER):
                some = numbers[x:x + _TOGETHER]
                ids = self._encode(b"".join([units[k] for k in some]))
                if ids is None:
                    apart += some
                else:
                    order += some
                    found.append(ids)
        bad = np.zeros(len(units), bool)
        for k in apart:
            ids = self._encode(units[k])
            if ids is None:
                bad[k] = True
            else:
                order.append(k)
                found.append(ids)
        order = np.array(order, np.int64)
        a, b = (np.concatenate([np.zeros(0, np.int64), *[ids[side] for ids in found]]) for side in (0, 1))
        ends_of = np.cumsum(np.array([len(units[k]) for k in order], np.int64))
        a_ends, b_ends = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        # Between two borders of either kind lies one piece of one A and one B token: a link.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])[:len(ends)]]
        a_at, b_at = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        shared = ends[(a_ends[a_at] == ends) & (b_ends[b_at] == ends)]
        n_a, n_b, n_groups, n_links = (np.zeros(len(units), np.int64) for _ in range(4))
        until = {}
        for name, n, borders in (("a", n_a, a_ends), ("b", n_b, b_ends), ("g", n_groups, shared), ("l", n_links, ends)):
            until[name] = np.searchsorted(borders, ends_of, side="right")
            n[order] = np.diff(until[name], prepend=0)
        if self._spells:
            spelled = [""] * len(units)
            for k, text in zip(order.tolist(), self._spell(a, b, a_ends, b_ends, shared, until)):
                spelled[k] = text
            self.spelled += spelled
        # Links in the order of the units' numbers.
        first = np.zeros(len(units), np.int64)
        first[order] = until["l"] - n_links[order]
        upto = np.cumsum(n_links)
        links = np.repeat(first - upto + n_links, n_links) + np.arange(len(ends))
        self.link_ends.add(upto + self.keys.size)
        self.keys.add((b[b_at] << _B_BITS | a[a_at])[links])
        for held, values in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, n_groups), (self.bad, bad)):
            held.add(values)

    def _spell(self, a, b, a_ends, b_ends, shared, until) -> list[str]:
        """The groups of each unit: A ids, a bar, B ids, joined by semicolons."""
        group = np.concatenate([np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((np.arange(len(group)), side, group))
        codes, group, side = np.concatenate([a, b])[order], group[order], side[order]
        last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[:len(group)]
        codes = codes + self._width * np.where(last, side + 1, 0)
        whole = "".join(map(self._written.__getitem__, codes.tolist()))
        ends = np.append(0, np.cumsum(self._written_sizes[codes]))[until["a"] + until["b"]].tolist()
        return [whole[x:y - 1] for x, y in zip([0, *ends[:-1]], ends)]

    def counted(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of the links of texts, and how many links have each."""
        often = np.bincount(np.concatenate([np.zeros(0, np.int64), *texts]), minlength=self.n_a.size)
        weights = np.repeat(often, np.diff(self.link_ends.all()))
        used = np.flatnonzero(weights)
        keys, back = np.unique(self.keys.all()[used], return_inverse=True)
        return keys, np.bincount(back, weights=weights[used], minlength=len(keys)).astype(np.int64)


def _chunks(texts) -> Iterator[list[str | None]]:
    """Consecutive texts, so many that a chunk is not long, at least one."""
    held, size = [], 0
    for text in texts:
        text = text.as_py()
        held.append(text)
        size += len(text or "")
        if size > _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix((keys >> _B_BITS).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _first_pass(make, buckets: int):
    """Rows of ``_PARTS``: the pairs of a split in a bucket, with their counts."""
    def run(batches):
        aligner, texts, size, split = make(False), [], 0, None

        def rows():
            keys, counts = aligner.counted(texts)
            bucket = bucket_of(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            found, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(order)]
            parts = [order[x:y] for x, y in zip(starts.tolist(), ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array([split] * len(parts), pa.int64()), pa.array(found, pa.int32()),
                 pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                 pa.array([counts[p].tobytes() for p in parts], pa.binary())], ["split", "bucket", "keys", "counts"])

        for batch in batches:
            splits = np.asarray(batch.column(0))
            edges = np.flatnonzero(np.append(True, splits[1:] != splits[:-1])[:len(splits)]).tolist()
            for x, y in zip(edges, [*edges[1:], len(splits)]):
                for chunk in _chunks(batch.column(1).slice(x, y - x)):
                    if splits[x] != split or size > COUNT_UNITS or aligner.full():
                        if texts:
                            yield rows()
                        texts, size, split = [], 0, int(splits[x])
                        if aligner.full():
                            aligner.start_afresh()
                    found = [numbers for numbers in aligner.units_of(chunk) if numbers is not None]
                    texts += found
                    size += sum(map(len, found))
        if texts:
            yield rows()
    return run


def _ints(column) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), np.int64) for v in column]


def _by_key(table: pa.Table, *columns: str) -> list[pa.Scalar]:
    return [table.column(c)[0] for c in columns]


def _row(key, name: str, values: np.ndarray) -> pa.Table:
    return pa.table([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                     pa.array([values.tobytes()], pa.binary())], ["bucket", "grp", name])


def _united(key, table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate(_ints(table.column("keys"))))
    return _row(key, "keys", keys)


def _hashed(batches):
    """A minimal perfect hash of each bucket's keys, and the keys in its order."""
    for batch in batches:
        for bucket, keys in zip(batch.column("bucket").to_pylist(), _ints(batch.column("keys"))):
            made = PerfectHash.build(keys)
            ordered = np.empty_like(keys)
            ordered[made.of(keys)] = keys
            sizes, bits = made.to_bytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), *[pa.array([v], pa.binary()) for v in (sizes, bits, ordered.tobytes())]],
                ["bucket", "sizes", "bits", "ordered"])


def _hash_of(table: pa.Table) -> tuple[PerfectHash, np.ndarray]:
    sizes, bits, ordered = (v.as_py() for v in _by_key(table, "sizes", "bits", "ordered"))
    return PerfectHash.from_bytes(sizes, bits), np.frombuffer(ordered, np.int64)


def _numbers_of(made: PerfectHash, ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = made.of(keys)
    if not (ordered[at] == keys).all():         # -1 looks at the last key, which differs too
        raise ValueError("a pair of ids is not in the table of pairs")
    return at


def _dense(key, parts: pa.Table, hashes: pa.Table) -> pa.Table:
    """The counts of some splits, as one vector in hash order."""
    made, ordered = _hash_of(hashes)
    total = np.zeros(len(ordered), np.int64)
    for keys, counts in zip(_ints(parts.column("keys")), _ints(parts.column("counts"))):
        np.add.at(total, _numbers_of(made, ordered, keys), counts)
    return _row(key, "counts", total)


def _summed(key, table: pa.Table) -> pa.Table:
    total = np.sum(_ints(table.column("counts")), axis=0, dtype=np.int64)
    return _row(key, "counts", total)


def _answered(key, parts: pa.Table, sums: pa.Table) -> pa.Table:
    """For the pairs of every split: corpus-wide count, negative unless it is the highest of the B id."""
    made, ordered = _hash_of(sums)
    counts = _ints(sums.column("counts"))[0]
    b, back = np.unique(ordered >> _B_BITS, return_inverse=True)
    highest = np.zeros(len(b), np.int64)
    np.maximum.at(highest, back, counts)
    signed = np.where(counts == highest[back], counts, -counts)
    answers = [signed[_numbers_of(made, ordered, keys)].tobytes() for keys in _ints(parts.column("keys"))]
    return pa.table({"split": parts.column("split").combine_chunks(), "keys": parts.column("keys").combine_chunks(),
                     "signed": pa.array(answers, pa.binary())})


def _second_pass(make):
    """The links of a split's documents, with the counts that the split asked for."""
    kept: dict = {}

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if "aligner" not in kept:
            kept["aligner"] = make(True)
        aligner = kept["aligner"]
        keys, signed = (np.concatenate([np.zeros(0, np.int64), *_ints(answers.column(c))]) for c in ("keys", "signed"))
        order = np.argsort(keys)
        keys, signed = keys[order], signed[order]
        out: list[tuple] = []
        waiting: list[np.ndarray | None] = []

        def finish():
            """Sums over the links of every unit that occurs, then over the units of every text."""
            used = np.unique(np.concatenate([np.zeros(0, np.int64), *[w for w in waiting if w is not None]]))
            ends = aligner.link_ends.all()
            sizes = ends[used + 1] - ends[used]
            upto = np.cumsum(sizes)
            links = np.repeat(ends[used] - upto + sizes, sizes) + np.arange(int(sizes.sum()))
            linked = aligner.keys.all()[links]
            at = np.searchsorted(keys, linked)
            if len(linked) and (at.max() >= len(keys) or not (keys[at] == linked).all()):
                raise ValueError("a pair of ids has no count")
            sums, best = (np.append(0, np.cumsum(v)) for v in (np.abs(signed[at]), signed[at] > 0))
            first = upto - sizes
            a, b, groups = aligner.n_a.all(), aligner.n_b.all(), aligner.n_groups.all()
            for numbers in waiting:
                if numbers is None:
                    out.append((0, 0, 0, 0, 0, 0, ""))
                    continue
                place = np.searchsorted(used, numbers)
                spelled = ";".join([aligner.spelled[n] for n in numbers.tolist()])
                out.append((int(a[numbers].sum()), int(b[numbers].sum()), int(groups[numbers].sum()),
                            int(sizes[place].sum()), int((best[upto[place]] - best[first[place]]).sum()),
                            int((sums[upto[place]] - sums[first[place]]).sum()),
                            hashlib.sha256(spelled.encode()).hexdigest()))
            waiting.clear()

        for chunk in _chunks(docs.column("text")):
            if aligner.full():
                finish()
                aligner.start_afresh()
            waiting += aligner.units_of(chunk)
        finish()
        columns = list(zip(*out)) if out else [[]] * 7
        return pa.table([docs.column("doc_id").combine_chunks(), *[pa.array(c, pa.int64()) for c in columns[:6]],
                         pa.array(columns[6], pa.string())],
                        names=[c.split()[0] for c in _OUT.split(", ")])
    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    ws = Workspace(spark, "alignment")
    rows = keyed_rows(ws, docs, doc_id=docs[id_col].cast("long"), text=docs[text_col])
    sizes = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    share = max(1, SPLIT_BYTES * max(sizes["n"], 1) // max(sizes["bytes"] or 0, 1))
    # Rows that lie together in a file, so that a task of the first pass meets few splits.
    rows = rows.select("doc_id", "text", F.expr(f"{ROW} - pmod(pmod({ROW}, 1L << 40), {share}L)").alias("split"))
    buckets = min(MOST_BUCKETS, tasks_for(spark))

    def make(spells: bool) -> Aligner:
        return Aligner(a_path, b_path, spells)

    parts = ws.keep(rows.select("split", "text").mapInArrow(_first_pass(make, buckets), _PARTS), "pairs")
    groups = -(-parts.select("split").distinct().count() // FAN) or 1
    parts = parts.withColumn("grp", F.expr(f"cast(pmod(xxhash64(split), {groups}) as int)"))

    def up_the_tree(level: DataFrame, step, schema: str, n: int, name: str) -> DataFrame:
        while n > 1:
            n = -(-n // FAN)
            level = ws.keep(level.withColumn("grp", F.expr(f"cast(pmod(grp, {n}) as int)"))
                            .groupBy("bucket", "grp").applyInArrow(_keyed(step), schema), name)
        return level

    united = "bucket int, grp int, keys binary"
    keys = ws.keep(parts.select("bucket", "grp", "keys").groupBy("bucket", "grp")
                   .applyInArrow(_keyed(_united), united), "keys")
    keys = up_the_tree(keys, _united, united, groups, "keys")
    hashes = ws.keep(keys.select("bucket", "keys").mapInArrow(
        _hashed, "bucket int, sizes binary, bits binary, ordered binary"), "hashes")

    def beside(table: DataFrame) -> DataFrame:
        """A bucket's row for every group of splits."""
        return table.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).groupBy("bucket", "grp")

    vector = "bucket int, grp int, counts binary"
    sums = ws.keep(parts.groupBy("bucket", "grp").cogroup(beside(hashes)).applyInArrow(
        _both(_dense, vector), vector), "vectors")
    sums = up_the_tree(sums, _summed, vector, groups, "sums")
    table = ws.keep(hashes.join(sums.select("bucket", "counts"), "bucket"), "table")
    answer = "split long, keys binary, signed binary"
    answers = ws.keep(parts.groupBy("bucket", "grp").cogroup(beside(table)).applyInArrow(
        _both(_answered, answer), answer), "answers")
    run = _second_pass(make)
    return rows.groupBy("split").cogroup(answers.groupBy("split")).applyInArrow(lambda x, y: run(x, y), _OUT)


def _keyed(step):
    """``step`` with the group's key as Python values."""
    return lambda key, table: step([k.as_py() for k in key], table)


def _both(step, schema: str):
    """``step`` for groups with rows on both sides; an empty table otherwise."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    empty = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]).empty_table()
    return lambda key, x, y: step([k.as_py() for k in key], x, y) if x.num_rows and y.num_rows else empty
