"""The conversion as one plain loop over one ordered log: the model the operators must match."""

from __future__ import annotations


def run(log, routes, update_image="changed", null_mode="keep", hide=True, start=(0, 0, 0), last=None):
    """Returns (numbered envelopes, records). ``log`` is one source partition in order."""
    batch, place, mid = start
    numbered, records = [], []
    for e in log:
        seq = (e["batch_id"] or 0, e["in_id"] or 0)
        if last is not None and not seq > last:
            continue
        last = seq
        route = routes.get(f"{e['header']['schema_name']}.{e['header']['table_name']}")
        if route is None:
            continue
        topic, keys, hidden = route
        change = e["row_change"]
        numbered.append((e["src_offset"], batch, place, mid))
        place += 1
        if e["entry_type"] == "TRANSACTIONEND" or (
            e["entry_type"] == "ROWDATA" and change and change["is_ddl"]
        ):
            batch, place = batch + 1, 0
        if not change or change["is_ddl"]:
            continue
        for number, item in enumerate(change["row_datas"]):
            src, cur, key = _row(change["event_type"], item, keys or [], hidden if hide else (),
                                 update_image, null_mode)
            records.append((e["src_offset"], number, topic, key, mid, change["event_type"], src, cur))
            mid += 1
    return numbered, records


def _row(event, item, keys, hidden, update_image, null_mode):
    before = [c for c in item["before"] if c["name"] not in (hidden or ())]
    after = [c for c in item["after"] if c["name"] not in (hidden or ())]

    def text(c):
        return None if c["is_null"] and null_mode == "keep" else c["value"]

    src, cur, parts = {}, {}, []
    if event == "DELETE":
        for c in before:
            src[c["name"]] = text(c)
            if c["is_key"]:
                cur[c["name"]] = text(c)
            if c["name"] in keys:
                parts.append(c["value"])
    elif event in ("INSERT", "UPDATE"):
        if event == "UPDATE":
            for c in before:
                src[c["name"]] = text(c)
        for c in after:
            whole = event == "INSERT" or update_image == "full"
            if whole or c["updated"] or c["is_key"] or c["name"] in keys:
                cur[c["name"]] = text(c)
            if c["name"] in keys:
                parts.append(c["value"])
    return src, cur, "\u0001".join(parts) if parts else None
