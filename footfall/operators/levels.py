"""Totals of several rollup levels from rows that stand together by identity.

Spark brings the rows of an identity to one task, in order; here they are counted once per level in
blocks of whole identities. What is repeated per level is so never moved, and held for a block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SESSION, VISITOR, AUTH, MARK = "session", "visitor", "auth", "mark"
#: Rows of a block, about; one identity with more is reduced to its different rows before more are added.
BLOCK = 100_000
COUNTS = ("new_comer_count", "visitor_count", "open_count", "total_page_count", "total_stay_time", "one_page_count", "old_auth", "first_auth")


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Values as numbers, null as one of them, and the values."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _joint(parts: list[np.ndarray]) -> np.ndarray:
    """One number per different combination of numbers."""
    code = parts[0]
    for part in parts[1:]:
        size = int(part.max()) + 1
        if (int(code.max()) + 1) * size >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * size + part
    return code


def _groups(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal numbers stand together, and where each begins."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    return order, np.flatnonzero(np.r_[True, code[1:] != code[:-1]])


def _filled(column: pa.ChunkedArray, null: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), null).to_numpy()


def _block_totals(rows: pa.Table, base: list[str], dims: list[str], levels: tuple[tuple[str, ...], ...]) -> Iterator[pa.RecordBatch]:
    """Totals of a block per level. Sums of blocks are the totals, as an identity is in one block."""
    kind = rows["kind"]
    identity = _joint([_codes(rows["day"])[0], _codes(rows["id"])[0]])
    marked = np.isin(identity, identity[pc.equal(kind, MARK).to_numpy()])
    counted = np.flatnonzero(~pc.equal(kind, MARK).to_numpy())
    rows, identity, marked = rows.take(pa.array(counted)), identity[counted], marked[counted]
    if not rows.num_rows:
        return
    kinds = {k: pc.equal(rows["kind"], k).to_numpy() for k in (SESSION, VISITOR, AUTH)}
    identity = _joint([np.unique(identity, return_inverse=True)[1], kinds[VISITOR] * 1 + kinds[AUTH] * 2])
    coded = {c: _codes(rows[c]) for c in (*base, *dims)}
    least = np.iinfo(np.int64).min
    page = np.where(pc.is_null(rows["pp"]).to_numpy(), -1, _codes(rows["pp"])[0])
    low_page = np.where(page < 0, np.iinfo(np.int64).max, page)
    pv, auth_first = _filled(rows["pv"], 0), _filled(rows["auth_first"], 0)
    stay, is_new = _filled(rows["stay"], least), _filled(rows["is_new"], least)
    is_new = np.where(marked & kinds[SESSION], np.maximum(is_new, 1), is_new)
    for number, level in enumerate(levels):
        order, at = _groups(_joint([identity, *[coded[c][0] for c in (*base, *level)]]))
        one = order[at]  # a row of each identity and value
        most = lambda values: np.maximum.reduceat(values[order], at)
        none = lambda values: np.where(values == least, 0, values)
        last_page = most(page)
        session = kinds[SESSION][one]
        counts = (
            none(most(is_new)), kinds[VISITOR][one], session, np.add.reduceat(pv[order], at), none(most(stay)),
            session & (last_page >= 0) & (np.minimum.reduceat(low_page[order], at) == last_page),
            kinds[AUTH][one], np.add.reduceat(auth_first[order], at),
        )
        into, begins = _groups(_joint([coded[c][0][one] for c in (*base, *level)]))
        row = one[into[begins]]
        columns = {c: coded[c][1].take(pa.array(coded[c][0][row])) for c in (*base, *level)}
        columns |= {c: pa.nulls(len(row), rows.schema.field(c).type) for c in dims if c not in level}
        columns |= {c: pa.array(np.add.reduceat(v.astype(np.int64)[into], begins)) for c, v in zip(COUNTS, counts, strict=True)}
        columns["_level"] = pa.array(np.full(len(row), number, dtype=np.int32))
        names = [*base, *dims, "_level", *COUNTS]
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)


def _different(rows: pa.Table, measures: dict[str, str]) -> pa.Table:
    """Rows of one identity, merged where they differ in measures only."""
    keys = [c for c in rows.column_names if c not in measures]
    merged = rows.group_by(keys).aggregate(list(measures.items()))
    return pa.table([merged[c if c in keys else f"{c}_{measures[c]}"] for c in rows.column_names], rows.column_names).cast(rows.schema)


def level_totals(base: list[str], dims: list[str], levels: tuple[tuple[str, ...], ...],
                 measures: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over rows that stand together by (day, id): totals per level, as parts that add up.

    ``measures`` tells how rows merge that are equal else.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, due = [], 0, BLOCK
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < due:
                continue
            rows = pa.Table.from_batches(held)
            last = pc.and_kleene(pc.equal(rows["id"], rows["id"][-1]), pc.equal(pc.fill_null(rows["day"], ""), rows["day"][-1].as_py() or ""))
            whole = pc.index(last, True).as_py()
            if whole:
                yield from _block_totals(rows.slice(0, whole), base, dims, levels)
            rest = rows.slice(whole)
            if rest.num_rows >= BLOCK:
                rest = _different(rest, measures)
            held, size = rest.combine_chunks().to_batches(), rest.num_rows
            due = max(BLOCK, 2 * size)
        if size:
            yield from _block_totals(pa.Table.from_batches(held), base, dims, levels)

    return run
