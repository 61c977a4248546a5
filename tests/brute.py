"""Row-at-a-time models of the SCD contract, to hold the Spark operators against."""

from __future__ import annotations


def _ranked(value):
    return (value is not None, value)


def _ordered_events(feed, key, seq, is_delete):
    """One event per key and sequence, in order: the greatest of equal ones."""
    best = {}
    for row in feed:
        at = (row[key], row[seq])
        rank = (is_delete(row), [_ranked(v) for k, v in row.items() if k != key])
        if at not in best or rank > best[at][0]:
            best[at] = (rank, row)
    by_key = {}
    for (k, _), (_, row) in best.items():
        by_key.setdefault(k, []).append(row)
    return {k: sorted(rows, key=lambda r: r[seq]) for k, rows in by_key.items()}


def filled(rows, columns, is_delete):
    held, out = {}, []
    for row in rows:
        row = dict(row)
        if is_delete(row):
            held = {}
        else:
            for c in columns:
                if row[c] is None:
                    row[c] = held.get(c)
                else:
                    held[c] = row[c]
        out.append(row)
    return out


def scd1(feed, key, seq, is_delete, keep_nulls=(), bound=None):
    out = {}
    for k, rows in _ordered_events(feed, key, seq, is_delete).items():
        rows = [r for r in rows if bound is None or r[seq] > bound]
        if rows and not is_delete(rows[-1]):
            out[k] = filled(rows, keep_nulls, is_delete)[-1]
    return out


def scd2(feed, key, seq, is_delete, tracked, keep_nulls=()):
    out = []
    for rows in _ordered_events(feed, key, seq, is_delete).values():
        version = None
        for row in filled(rows, keep_nulls, is_delete):
            if is_delete(row):
                if version:
                    out.append({**version, "end": row[seq]})
                version = None
                continue
            same = version and all(version["row"][c] == row[c] for c in tracked)
            if same:
                version["row"] = row
            else:
                if version:
                    out.append({**version, "end": row[seq]})
                version = {"row": row, "start": row[seq], "end": None}
        if version:
            out.append(version)
    return out
