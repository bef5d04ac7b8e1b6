"""Ledger with a minimum balance over range pieces.

A withdrawal that would take the balance below the minimum is refused: a sequential rule. The rows are
range-partitioned on (account, order), so an account may go on in the next partitions, and what a partition
needs is the balance at which its first account starts. Four passes, whatever is refused:

1. The rows are written once, sorted, in a reliable checkpoint.
2. Every partition tells its first and last account. If they differ, the last account starts in this
   partition, at zero, and is replayed for its end balance. If the partition holds one account only, its start is not
   known: the partition gives its end as a step function of the start (a transfer table).
3. The tables of an account are looked up one after another, from the first known end: one search per table.
4. Every partition replays its rows from the start of its first account; all other accounts start at zero.

A transfer table is a list of (from, offset): a start in [from, next from) ends at start + offset. A deposit
adds to all offsets; a withdrawal x cuts a step where start + offset reaches minimum + x. A table is closed at ``STEPS`` steps
and a new one is begun, so a table stays small however much is refused, and a long piece has several.

Amounts are 64-bit integers, so sums are exact in any grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.session import checkpointed

#: Steps at which a transfer table is closed.
STEPS = 4096
_FAR = 1 << 62


def runs_of(column) -> list[tuple[int, int]]:
    """(first row, row after the last) of every run of equal values; nulls are equal to each other."""
    import numpy as np
    new = ~((column == column.shift()) | (column.isna() & column.shift().isna())).to_numpy(dtype=bool)
    new[:1] = True
    cut = np.r_[np.flatnonzero(new), len(column)]
    return list(zip(cut[:-1].tolist(), cut[1:].tolist()))


def same_key(a, b) -> bool:
    import pandas as pd
    return (pd.isna(a) and pd.isna(b)) or a == b


def replay(amounts, balance: int, lo: int, balances=None, accepted=None) -> int:
    """The balance after ``amounts`` (64-bit integers), the balances and decisions after each into the arrays, if
    given. Stretches without a refusal are added at once."""
    import numpy as np
    i, step = 0, 64
    while i < len(amounts):
        part = amounts[i:i + step]
        after = balance + np.cumsum(part)
        refused = np.flatnonzero((part < 0) & (after < lo))
        j = refused[0] if len(refused) else len(part)
        if balances is not None:
            balances[i:i + j], accepted[i:i + j] = after[:j], True
        balance = int(after[j - 1]) if j else balance
        if len(refused):
            if balances is not None:
                balances[i + j], accepted[i + j] = balance, False
            i, step = i + j + 1, 64
        else:
            i, step = i + j, min(2 * step, 1 << 16)
    return balance


def transfer_tables(amounts, lo: int, steps: int) -> Iterator[tuple]:
    """(from, offset) arrays, one pair per stretch of ``amounts``; together they hold all rows."""
    import numpy as np
    least = min(0, lo)  # no balance is below it
    begin, offset, added = np.array([least]), np.array([0]), 0  # ``added``: deposits to add to all offsets
    for x in amounts.tolist():
        if x >= 0:
            added += x
            continue
        cut = lo - x - added - offset  # the start from which a step accepts
        end = np.r_[begin[1:], _FAR]
        inside = (cut > begin) & (cut < end)
        all_begin = np.r_[begin, cut[inside]]
        all_offset = np.r_[np.where(cut <= begin, offset + x, offset), offset[inside] + x]
        order = np.argsort(all_begin, kind="stable")
        begin, offset = all_begin[order], all_offset[order]
        new = np.r_[True, offset[1:] != offset[:-1]]
        begin, offset = begin[new], offset[new]
        if len(begin) >= steps:
            yield begin, offset + added
            begin, offset, added = np.array([least]), np.array([0]), 0
    yield begin, offset + added


def _borders(batches, account: str, lo: int, steps: int):
    """Rows of one partition: its first and last account; the last one's end balance, or the transfer tables."""
    import pandas as pd
    held = [b for b in batches if len(b)]
    if not held:
        return
    pdf = pd.concat(held, ignore_index=True)
    runs, amounts, pid = runs_of(pdf[account]), pdf["_units"].to_numpy(dtype="int64"), int(pdf["_pid"].iloc[0])
    first, last = pdf[account].iloc[0], pdf[account].iloc[-1]
    tables = [(None, None)] if len(runs) > 1 else transfer_tables(amounts, lo, steps)
    end = replay(amounts[slice(*runs[-1])], 0, lo) if len(runs) > 1 else None
    for k, (begin, offset) in enumerate(tables):
        yield pd.DataFrame({"first": [first], account: [last], "pid": [pid], "part": [k], "end": pd.array([end], dtype="Int64"),
                            "begin": [None if begin is None else begin.astype("<i8").tobytes()],
                            "offset": [None if offset is None else offset.astype("<i8").tobytes()]})


def _ends(batches, account: str):
    """Sorted by (account, pid, part): the end balance of the account in every partition whose last account it is."""
    import numpy as np
    import pandas as pd
    key, pid, balance, out = None, None, 0, []
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            row = dict(zip(pdf.columns, r))
            if pid is None or not same_key(key, row[account]):
                key, balance = row[account], 0
            pid = row["pid"]
            if row["begin"] is None:
                balance = int(row["end"])
            else:
                begin, offset = (np.frombuffer(row[c], dtype="<i8") for c in ("begin", "offset"))
                balance += int(offset[np.searchsorted(begin, balance, side="right") - 1])
            if out and out[-1][0] == pid:
                out.pop()
            out.append((pid, balance))
        yield pd.DataFrame(out[:-1], columns=["pid", "balance"])
        out = out[-1:]
    yield pd.DataFrame(out, columns=["pid", "balance"])


def first_starts(laid: DataFrame, account: str, lo: int) -> dict[int, int]:
    """Balance at which the first account of a partition starts, where that is not zero's own: one number
    per partition."""
    kind, steps = laid.schema[account].dataType, STEPS
    rows = checkpointed(laid.select(account, "_units", "_pid").mapInPandas(
        lambda b: _borders(b, account, lo, steps), T.StructType([
            T.StructField("first", kind), T.StructField(account, kind), T.StructField("pid", T.IntegerType()),
            T.StructField("part", T.IntegerType()), T.StructField("end", T.LongType()),
            T.StructField("begin", T.BinaryType()), T.StructField("offset", T.BinaryType())])))
    ends = rows.drop("first").repartition(account).sortWithinPartitions(account, "pid", "part").mapInPandas(
        lambda b: _ends(b, account), "pid int, balance long")
    known = {r["pid"]: r["balance"] for r in ends.collect()}
    starts, before = {}, None
    for r in sorted(rows.where("part = 0").select("pid", "first", F.col(account).alias("last")).collect(), key=lambda r: r["pid"]):
        if before is not None and same_key(before["last"], r["first"]):
            starts[r["pid"]] = known[before["pid"]]
        before = r
    return starts


def replayed(laid: DataFrame, account: str, lo: int, starts: dict[int, int], balance: str, accepted: str) -> DataFrame:
    """Sorted partitions replayed, batch by batch; the first account of a partition starts at ``starts[_pid]``,
    every other one at zero."""
    schema = T.StructType(laid.schema.fields + [T.StructField(balance, T.LongType()), T.StructField(accepted, T.BooleanType())])

    def run(batches):
        import numpy as np
        key, now, begun = None, 0, False
        for pdf in batches:
            amounts, balances, ok = pdf["_units"].to_numpy(dtype="int64"), np.empty(len(pdf), "int64"), np.empty(len(pdf), bool)
            for a, b in runs_of(pdf[account]) if len(pdf) else ():
                mine = pdf[account].iloc[a]
                if not begun:
                    now, begun = starts.get(int(pdf["_pid"].iloc[a]), 0), True
                elif not same_key(key, mine):
                    now = 0
                key = mine
                now = replay(amounts[a:b], now, lo, balances[a:b], ok[a:b])
            pdf[balance], pdf[accepted] = balances, ok
            yield pdf
    return laid.mapInPandas(run, schema)


def replay_pieces(ledger: DataFrame, account: str, order: list[str], lo: int, partitions: int, balance: str, accepted: str) -> DataFrame:
    """``ledger`` (with ``_units``) replayed over ``partitions`` range pieces."""
    laid = checkpointed(ledger.repartitionByRange(partitions, account, *order).sortWithinPartitions(account, *order)
                        .withColumn("_pid", F.spark_partition_id()))
    return replayed(laid, account, lo, first_starts(laid, account, lo), balance, accepted)


def replay_stream(ledger: DataFrame, account: str, order: list[str], lo: int, partitions: int, balance: str, accepted: str) -> DataFrame:
    """``ledger`` replayed with every account whole in one sorted partition."""
    whole = ledger.repartition(partitions, account).sortWithinPartitions(account, *order).withColumn("_pid", F.spark_partition_id())
    return replayed(whole, account, lo, {}, balance, accepted)
