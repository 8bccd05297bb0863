"""Byte strings that repeat across documents, found by a distributed merge of suffixes.

A string of WIDTH bytes is represented by one position within it, its anchor: that of
its smallest hash of GRAM bytes. Equal strings have their anchors at equal places, so
only suffixes that start at anchors need sorting, with what stands left of the anchor
behind them. That is one suffix in about sixteen, and of those only the ones whose
first GRAM bytes occur in two documents are sorted at all.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, whole

WIDTH = 50
GRAM = 20
WINDOW = WIDTH - GRAM + 1
LEFT = WIDTH - GRAM
# A sorted key: the suffix, its length, what stands left of it backwards, its length.
KEY = WIDTH + 1 + LEFT + 1
# Bytes of text that are in memory together, of which hashes are taken together, and
# whose suffixes are merged together.
GROUP_BYTES = 8 << 20
CHUNK = 1 << 20
PART_BYTES = 12 << 20
# Lists or runs that are in memory together, and tasks that a shuffle is dealt to.
FAN = 4096
TASKS = 20_000

_HASH_BITS = np.uint64((1 << 40) - 1)
_NO_DOC = np.iinfo(np.int64).max


class _Anchors:
    """Anchors of all strings of some documents, laid end to end in `data`.

    Strings lo..hi of a document (by their first byte) have their anchor at `at`.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = self.ends - [len(t) for t in texts]
        found = [np.zeros((0, 5), np.uint64)]
        first = 0
        for last in range(1, len(texts) + 1):
            size = self.ends[last - 1] - self.starts[first]
            if last == len(texts) or size >= CHUNK:
                found.append(self._of(first, last))
                first = last
        rows = np.concatenate(found)
        self.lo, self.hi, self.at, self.doc = rows[:, :4].astype(np.int64).T
        self.hash = rows[:, 4]

    def _of(self, first: int, last: int) -> np.ndarray:
        base = int(self.starts[first])
        data = self.data[base : self.ends[last - 1]]
        if len(data) < WIDTH:
            return np.zeros((0, 5), np.uint64)
        hashes = _gram_hashes(data)
        place = np.arange(len(hashes), dtype=np.uint64)
        # The place decides between equal hashes: the leftmost is the anchor.
        least = (hashes >> np.uint64(32) << np.uint64(32)) | place
        span = 1
        while span * 2 <= WINDOW:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = WINDOW - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(len(anchor), bool)
        for doc in range(first, last):
            end = self.ends[doc] - base - WIDTH + 1
            inside[self.starts[doc] - base : max(end, self.starts[doc] - base)] = True
        change = np.flatnonzero(np.diff(anchor)) + 1
        new = np.zeros(len(anchor), bool)
        new[0] = True
        new[change] = True
        new[1:] |= ~inside[:-1]
        old = np.append(new[1:], True)
        old[:-1] |= ~inside[1:]
        lo, hi = np.flatnonzero(new & inside), np.flatnonzero(old & inside)
        at = anchor[lo]
        doc = np.searchsorted(self.starts, lo + base, "right") - 1
        places = np.stack([lo + base, hi + base, at + base, doc], axis=1)
        return np.column_stack([places.astype(np.uint64), hashes[at] & _HASH_BITS])

    def only(self, keep: np.ndarray) -> None:
        self.lo, self.hi, self.at, self.doc, self.hash = (
            x[keep] for x in (self.lo, self.hi, self.at, self.doc, self.hash)
        )

    def keys(self) -> np.ndarray:
        """One key per anchor, KEY bytes each, in a matrix padded to whole words."""
        keys = np.zeros((len(self.at), -(-KEY // 8) * 8), np.uint8)
        right, left = self.hi + WIDTH - self.at, self.at - self.lo
        top = max(len(self.data) - 1, 0)
        for rows in range(0, len(keys), CHUNK // 16):
            part = slice(rows, rows + CHUNK // 16)
            at = self.at[part, None]
            ahead, back = np.arange(WIDTH), np.arange(LEFT)
            keys[part, :WIDTH] = self.data[np.minimum(at + ahead, top)] * (ahead < right[part, None])
            behind = self.data[np.maximum(at - 1 - back, 0)] * (back < left[part, None])
            keys[part, WIDTH + 1 : WIDTH + 1 + LEFT] = behind
        keys[:, WIDTH] = right
        keys[:, KEY - 1] = left
        return keys


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    base = 0x9E3779B97F4A7C15
    one = data.astype(np.uint64) + np.uint64(1)
    powers = {1: one}
    span = 1
    while span * 2 <= GRAM:
        half = powers[span]
        factor = np.uint64(pow(base, span, 1 << 64))
        powers[span * 2] = half[:-span] * factor + half[span:]
        span *= 2
    done, hashes = span, powers[span]
    while done < GRAM:
        step = max(s for s in powers if s <= GRAM - done)
        size = len(data) - done - step + 1
        factor = np.uint64(pow(base, step, 1 << 64))
        hashes = hashes[:size] * factor + powers[step][done : done + size]
        done += step
    hashes ^= hashes >> np.uint64(33)
    hashes *= np.uint64(0xFF51AFD7ED558CCD)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xC4CEB9FE1A85EC53)
    return hashes ^ (hashes >> np.uint64(32))


def _sorted_order(keys: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    return np.lexsort(words.T[::-1])


def _common(keys: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before it; 0 for the first."""
    if len(keys) < 2:
        return np.zeros(len(keys), np.int64)
    differ = keys[1:] != keys[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
    return np.concatenate([[0], common])


def _classes(anchors: _Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their common prefixes and hashes; the class of each anchor."""
    keys = anchors.keys()
    order = _sorted_order(keys)
    keys = keys[order][:, :KEY]
    common = _common(keys)
    new = common < KEY
    new[:1] = True
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    return keys[new], common[new], anchors.hash[first], which


def _texts(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    texts = table.column("text").cast(pa.binary()).to_pylist()
    return texts, table.column("number").to_numpy()


def _rows(names: list[str], rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SEEN = pa.schema([("part", pa.int64()), ("gid", pa.int64()), ("hashes", pa.binary()), ("many", pa.binary())])
_RUN = pa.schema(
    [("part", pa.int64()), ("gid", pa.int64()), ("common", pa.binary()), ("tails", pa.binary()), ("least", pa.binary())]
)
_FOUND = pa.schema(
    [("gid", pa.int64()), ("part", pa.int64()), ("least", pa.binary()), ("mixed", pa.binary()), ("rows", pa.binary())]
)


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


def _list_hashes(parts: int):
    """Hashes of a group's anchors, by part, and whether several documents have them."""

    def compute(table: pa.Table) -> pa.Table:
        texts, numbers = _texts(table)
        gid = table.column("gid")[0].as_py()
        anchors = _Anchors(texts)
        numbers = numbers[anchors.doc]
        order = np.lexsort([numbers, anchors.hash])
        hashes, numbers = anchors.hash[order], numbers[order]
        new = np.diff(hashes, prepend=hashes[:1] + np.uint64(1)) != 0
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(hashes)) - 1
        hashes, many = hashes[starts], numbers[starts] != numbers[ends] if len(starts) else new
        part = _part_of(hashes, parts)
        rows = []
        for p in np.unique(part):
            own = part == p
            rows.append((int(p), gid, _pack(hashes[own]), np.packbits(many[own]).tobytes()))
        return _rows(_SEEN.names, rows, _SEEN)

    return compute


def _pack(hashes: np.ndarray) -> bytes:
    """Sorted numbers under 2^40 as differences, in their bytes by significance."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(steps[:, :5].T).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(5, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :5] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _joined(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The lists of hashes; all their hashes, and whether several documents have them."""
    lists = [_unpack(x.as_py()) for x in table.column("hashes")]
    many = [
        np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(h)).astype(bool)
        for m, h in zip(table.column("many"), lists, strict=True)
    ]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    known = np.concatenate([h[m] for h, m in zip(lists, many, strict=True)])
    return lists, values, (counts > 1) | np.isin(values, known)


def _join_hashes(table: pa.Table) -> pa.Table:
    """The lists of a block of groups as one."""
    _, values, many = _joined(table)
    part, block = (table.column(c)[0].as_py() for c in ("part", "block"))
    return _rows(_SEEN.names, [(part, block, _pack(values), np.packbits(many).tobytes())], _SEEN)


def _repeated_of(table: pa.Table, lists: list[np.ndarray], again: np.ndarray) -> pa.Table:
    part = table.column("part")[0].as_py()
    rows = []
    for gid, hashes in zip(table.column("gid").to_pylist(), lists, strict=True):
        own = np.intersect1d(hashes, again, assume_unique=True)
        if len(own):
            rows.append((part, gid, _pack(own), b""))
    return _rows(_SEEN.names, rows, _SEEN)


def _repeated_hashes(table: pa.Table) -> pa.Table:
    """The hashes of one part that several documents have, for each group that has them."""
    lists, values, many = _joined(table)
    return _repeated_of(table, lists, values[many])


def _pass_hashes(table: pa.Table, repeated: pa.Table) -> pa.Table:
    """What is known of a block's hashes, for each of its groups."""
    if not repeated.num_rows:
        return _rows(_SEEN.names, [], _SEEN)
    lists = [_unpack(x.as_py()) for x in table.column("hashes")]
    return _repeated_of(table, lists, _unpack(repeated.column("hashes")[0].as_py()))


def _repeated_anchors(docs: pa.Table, repeated: pa.Table) -> tuple[_Anchors, list[bytes], np.ndarray]:
    texts, numbers = _texts(docs)
    anchors = _Anchors(texts)
    hashes = [_unpack(x.as_py()) for x in repeated.column("hashes")]
    anchors.only(np.isin(anchors.hash, np.concatenate([*hashes, np.zeros(0, np.uint64)])))
    return anchors, texts, numbers


def _sorted_runs(parts: int):
    """A group's distinct keys as sorted, front-coded runs, one per part."""

    def compute(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows(_RUN.names, [], _RUN)
        anchors, _, numbers = _repeated_anchors(docs, repeated)
        gid = docs.column("gid")[0].as_py()
        keys, _, hashes, which = _classes(anchors)
        least = np.full(len(keys), _NO_DOC)
        np.minimum.at(least, which, numbers[anchors.doc])
        part = _part_of(hashes, parts)
        rows = []
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            rows.append((int(p), gid, *_front_coded(keys[own], _common(keys[own])), least[own].tobytes()))
        return _rows(_RUN.names, rows, _RUN)

    return compute


def _front_coded(keys: np.ndarray, common: np.ndarray) -> tuple[bytes, bytes]:
    """Bytes in common with the key before, and the rest of each key."""
    return common.astype(np.uint8).tobytes(), keys[np.arange(KEY) >= common[:, None]].tobytes()


def _read_run(common: bytes, tails: bytes) -> Iterator[tuple[int, bytes]]:
    key, at = b"", 0
    for length in common:
        end = at + KEY - length
        key = key[:length] + tails[at:end]
        at = end
        yield length, key


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """All keys of sorted runs in order: run number, bytes in common with the last, key.

    A loser tree that keeps with every loser how many bytes it shares with the key
    that beat it. The one that shares more with the last key put out is smaller; only
    when both share equally many are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes] = [b""] * size
    loser, shared = [0] * size, [0] * size

    def pull(run: int) -> int:
        """The next key of a run becomes its head; -1 when there is none."""
        got = next(runs[run], None) if run < len(runs) else None
        if got is None:
            return -1
        heads[run] = got[1]
        return got[0]

    def play(a: int, in_a: int, b: int, in_b: int) -> tuple[int, int, int, int]:
        """Winner and loser with the bytes they share with what came before."""
        if in_a != in_b or in_a < 0:
            return (a, in_a, b, in_b) if in_a >= in_b else (b, in_b, a, in_a)
        x, y = heads[a], heads[b]
        differ = int.from_bytes(x[in_a:], "big") ^ int.from_bytes(y[in_a:], "big")
        same = KEY - (differ.bit_length() + 7) // 8
        if same == KEY or x[same] < y[same]:
            return a, in_a, b, same
        return b, in_b, a, same

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            run = node - size
            return run, min(pull(run), 0)
        left, right = build(2 * node), build(2 * node + 1)
        winner, in_winner, loser[node], shared[node] = play(*left, *right)
        return winner, in_winner

    run, common = build(1)
    while common >= 0:
        yield run, common, heads[run]
        common = pull(run)
        node = (run + size) >> 1
        while node:
            other, in_other = loser[node], shared[node]
            if common < in_other:
                loser[node], shared[node] = run, common
                run, common = other, in_other
            elif common == in_other and common >= 0:
                run, common, loser[node], shared[node] = play(run, common, other, in_other)
            node >>= 1


class _Merged:
    """Distinct keys of several runs in order, with their smallest documents."""

    def __init__(self, table: pa.Table):
        self.part = table.column("part")[0].as_py()
        self.gids = table.column("gid").to_pylist()
        columns = (table.column(c).to_pylist() for c in ("common", "tails", "least"))
        common, tails, least = columns
        least = [np.frombuffer(x, np.int64) for x in least]
        number = np.empty(sum(map(len, least)), np.int32)
        shared = np.empty(len(number), np.uint8)
        distinct = bytearray()
        for i, (run, same, key) in enumerate(merge_runs([_read_run(*x) for x in zip(common, tails, strict=True)])):
            number[i], shared[i] = run, same
            if same < KEY or not i:
                distinct += key
        new = shared < KEY
        new[:1] = True
        which = np.cumsum(new) - 1
        self.keys = np.frombuffer(bytes(distinct), np.uint8).reshape(-1, KEY)
        self.shared = shared[new].astype(np.int64)
        # Keys of one run come out in its order.
        order = np.argsort(number, kind="stable")
        self.lowest = np.full(len(self.keys), _NO_DOC)
        np.minimum.at(self.lowest, which[order], np.concatenate(least))
        # For each run, the places of its keys among all.
        self.places = np.split(which[order], np.cumsum([len(x) for x in least])[:-1])

    def answers(self, lowest: np.ndarray, mixed: np.ndarray, rows: np.ndarray) -> pa.Table:
        """What is known of the keys, for each run in the order of its own."""
        slot = np.full(len(self.keys), -1, np.int64)
        slot[mixed] = np.arange(len(mixed))
        out = []
        for gid, classes in zip(self.gids, self.places, strict=True):
            own = np.flatnonzero(slot[classes] >= 0)
            found = (lowest[classes], own.astype(np.int64), rows[slot[classes[own]]])
            out.append((gid, self.part, *(x.tobytes() for x in found)))
        return _rows(_FOUND.names, out, _FOUND)


def _merge_block(table: pa.Table) -> pa.Table:
    """The runs of a block of groups as one."""
    merged = _Merged(table)
    block = table.column("block")[0].as_py()
    run = (merged.part, block, *_front_coded(merged.keys, merged.shared), merged.lowest.tobytes())
    return _rows(_RUN.names, [run], _RUN)


def _merge_part(table: pa.Table) -> pa.Table:
    """The smallest document of every string of one part, for each run that has it."""
    merged = _Merged(table)
    mixed, rows = _by_string(merged.keys, merged.shared, merged.lowest)
    return merged.answers(merged.lowest, mixed, rows)


def _pass_found(table: pa.Table, found: pa.Table) -> pa.Table:
    """What is known of a block's strings, for each of its groups."""
    lowest, mixed, rows = (
        np.frombuffer(found.column(c)[0].as_py(), np.int64) for c in ("least", "mixed", "rows")
    )
    return _Merged(table).answers(lowest, mixed, rows.reshape(-1, LEFT + 1))


def _dealt(rows: DataFrame, number: int, *keys: str) -> DataFrame:
    return rows.repartition(min(number, TASKS), *keys)


def _of_parts(lists: DataFrame, groups: int, parts: int, up, top, down, made: str, answer: str) -> DataFrame:
    """`top` of each part's lists, one per group, FAN of them in one place at most.

    With more groups than that, `up` makes one list of those of a block of groups, and
    `down` takes what is answered to a block back to its groups.
    """
    if groups <= FAN:
        return _dealt(lists, parts, "part").groupBy("part").applyInArrow(top, answer)
    blocks = groups // FAN + 1
    blocked = lists.withColumn("block", F.expr(f"gid div {FAN}"))
    blocked = _dealt(blocked, parts * blocks, "part", "block").groupBy("part", "block")
    answers = _of_parts(blocked.applyInArrow(up, made), blocks, parts, up, top, down, made, answer)
    answers = _dealt(answers, parts * blocks, "part", "gid").groupBy("part", "gid")
    return blocked.cogroup(answers).applyInArrow(down, answer)


def _by_string(keys: np.ndarray, shared: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest documents by string, and in `lowest` for keys where all agree.

    String j of a key starts j bytes left of the anchor. It equals that of another
    key when the suffixes share WIDTH - j bytes, as the merge has found, and the left
    sides j bytes. Returns the keys whose strings differ in that, and their rows.
    """
    number = len(keys)
    right, left = keys[:, WIDTH].astype(np.int64), keys[:, KEY - 1].astype(np.int64)
    behind = np.zeros((number, -(-LEFT // 8) * 8), np.uint8)
    behind[:, :LEFT] = keys[:, WIDTH + 1 : WIDTH + 1 + LEFT]
    order = _sorted_order(behind)
    common = _common(behind[order])
    low, high = np.full(number, _NO_DOC), np.full(number, np.iinfo(np.int64).min)
    strings = []
    for j in range(LEFT + 1):
        has = np.flatnonzero((right >= WIDTH - j) & (left >= j))
        suffix = np.cumsum(shared < WIDTH - j)
        side = np.empty(number, np.int64)
        side[order] = np.cumsum(common < j)
        string = suffix[has] * (number + 1) + side[has]
        sort = np.argsort(string, kind="stable")
        starts = np.flatnonzero(np.diff(string[sort], prepend=-1))
        counts = np.diff(np.append(starts, len(sort)))
        docs = lowest[has[sort]]
        least = np.repeat(np.minimum.reduceat(docs, starts), counts) if len(starts) else docs
        has = has[sort]
        low[has] = np.minimum(low[has], least)
        high[has] = np.maximum(high[has], least)
        strings.append((has, least))
    mixed = np.flatnonzero(low < high)
    slot = np.full(number, -1, np.int64)
    slot[mixed] = np.arange(len(mixed))
    rows = np.full((len(mixed), LEFT + 1), _NO_DOC)
    for j, (has, least) in enumerate(strings):
        own = slot[has] >= 0
        rows[slot[has[own]], j] = least[own]
    lowest[:] = low
    return mixed, rows


def _cut(schema: pa.Schema, parts: int):
    """Documents of a group without the strings that a smaller document has."""

    def compute(docs: pa.Table, repeated: pa.Table, found: pa.Table) -> pa.Table:
        anchors, texts, numbers = _repeated_anchors(docs, repeated)
        _, _, hashes, which = _classes(anchors)
        part = _part_of(hashes, parts)
        lowest = np.full(len(hashes), _NO_DOC)
        slot = np.full(len(hashes), -1, np.int64)
        rows = [np.zeros((0, LEFT + 1), np.int64)]
        size = 0
        for p, least, mixed, values in zip(
            *(found.column(c).to_pylist() for c in ("part", "least", "mixed", "rows")), strict=True
        ):
            own = np.flatnonzero(part == p)
            lowest[own] = np.frombuffer(least, np.int64)
            places = own[np.frombuffer(mixed, np.int64)]
            slot[places] = size + np.arange(len(places))
            rows.append(np.frombuffer(values, np.int64).reshape(-1, LEFT + 1))
            size += len(places)
        strings = np.concatenate(rows)
        number = numbers[anchors.doc]
        plain = (slot[which] < 0) & (lowest[which] < number)
        starts, ends = [anchors.lo[plain]], [anchors.hi[plain] + WIDTH]
        some = np.flatnonzero(slot[which] >= 0)
        for j in range(LEFT + 1):
            gone = some[strings[slot[which[some]], j] < number[some]]
            starts.append(anchors.at[gone] - j)
            ends.append(anchors.at[gone] - j + WIDTH)
        depth = np.zeros(len(anchors.data) + 1, np.int32)
        np.add.at(depth, np.concatenate(starts), 1)
        np.add.at(depth, np.concatenate(ends), -1)
        gone = np.cumsum(depth[:-1]) > 0
        removed, spans, kept = [], [], []
        for start, end, text in zip(anchors.starts, anchors.ends, texts, strict=True):
            own = gone[start:end]
            removed.append(int(np.count_nonzero(own)))
            spans.append(int(np.count_nonzero(own[1:] & ~own[:-1])) + int(own[:1].any()))
            kept.append(anchors.data[start:end][~own].tobytes() if removed[-1] else text)
        columns = [docs.column("doc_id").combine_chunks(), list(map(len, texts)), removed, spans, kept]
        return pa.table(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
            schema=schema,
        )

    return compute


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Documents without bytes of strings that a document with a smaller doc_id has.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal runs removed) and kept, the
    remaining bytes, which need not be valid UTF-8. A byte goes if a string of WIDTH
    bytes that covers it also starts in a document with a smaller doc_id; strings are
    those of the input and never cross documents.

    doc_id must be integral, else a TypeError is raised. A null one is smaller than all
    others; rows with one doc_id do not repeat each other. Null texts are empty, texts
    under WIDTH bytes stay whole. Other columns are not looked at. No row is lost, an
    empty table gives none.

    Documents are dealt into groups by a hash of doc_id and text, so rows without a
    doc_id are in all groups; only rows equal in both stay together. Each group lists
    the hashes of its anchors; those that several documents have are sent back. The
    suffixes at such anchors are sorted within the group and sent to their part as a
    front-coded run, with the smallest document of each distinct one. Parts merge their
    runs and answer with the smallest document of each string. A part is
    chosen by a hash of a suffix's first GRAM bytes, not by splitters of the suffixes: what
    shares GRAM bytes meets, and parts have no order among each other.

    Copies are one key per group, and runs of more than FAN groups are merged in levels,
    so a string that every group has is FAN keys in one place, not one for each group.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
    if kind not in ids:
        raise TypeError(f"doc_id must be integral, not {kind}")
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups, parts = total // GROUP_BYTES + 1, total // PART_BYTES + 1
    least = F.lit(np.iinfo(np.int64).min)
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("gid"),
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), least).alias("number"),
        "text",
    )
    grouped = _dealt(rows, groups, "gid").groupBy("gid")
    seen = grouped.applyInArrow(_list_hashes(parts), _sql(_SEEN))
    steps = (_join_hashes, _repeated_hashes, _pass_hashes, _sql(_SEEN), _sql(_SEEN))
    repeated = _of_parts(seen, groups, parts, *steps)
    of_group = _dealt(repeated, groups, "gid").groupBy("gid")
    runs = grouped.cogroup(of_group).applyInArrow(_sorted_runs(parts), _sql(_RUN))
    steps = (_merge_block, _merge_part, _pass_found, _sql(_RUN), _sql(_FOUND))
    found = _of_parts(runs, groups, parts, *steps)
    # Both lists that go back to a group, in one table.
    both = repeated.select(
        "gid", "part", "hashes", *(F.lit(None).cast("binary").alias(c) for c in ("least", "mixed", "rows"))
    ).union(found.select("gid", "part", F.lit(None).cast("binary"), "least", "mixed", "rows"))
    schema = pa.schema(
        [
            ("doc_id", ids[kind]),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept", pa.binary()),
        ]
    )
    cut = _cut(schema, parts)

    def last(docs: pa.Table, lists: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        of_hashes = lists.column("hashes").is_valid()
        return cut(docs, lists.filter(of_hashes), lists.filter(pa.compute.invert(of_hashes)))

    kinds = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    return grouped.cogroup(_dealt(both, groups, "gid").groupBy("gid")).applyInArrow(last, kinds)


def query(spark, sf_dir) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
