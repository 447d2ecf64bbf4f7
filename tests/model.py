"""Plain one-row-at-a-time models of the order-dependent rules, for comparison on small inputs."""

from leadweave.schemas import CONTACT_COLUMNS, FILL_COLUMNS, LIST_COLUMNS

RANK = {"apollo": 2, "hunter": 1}


def common_length(a, b):
    """Length of the longest common subsequence by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[-1], before[j + 1]))
    return row[-1]


def alike(a, b):
    return bool(a) and bool(b) and 400 * common_length(a, b) > 169 * (len(a) + len(b))


def union(*texts):
    return ", ".join(sorted({v.strip() for t in texts for v in t.split(",") if v.strip()}))


def join_two(old, new):
    out = dict(old)
    for c in LIST_COLUMNS:
        out[c] = union(old[c], new[c])
    for c in FILL_COLUMNS:
        if out[c] in ("", None, 0) and new[c] not in ("", None, 0):
            out[c] = new[c]
    a, b = RANK.get(old["contact_source"], 0), RANK.get(new["contact_source"], 0)
    if b > a:
        out.update({c: new[c] for c in CONTACT_COLUMNS})
    elif a == b == 0:
        for c in CONTACT_COLUMNS:
            if out[c] in ("", None) and new[c] not in ("", None):
                out[c] = new[c]
    return out


def resolve(rows):
    """rows: dicts with seq, domain, name_key; returns {seq: leader} and merged rows by leader."""
    leader_of, merged, by_domain, names = {}, {}, {}, []
    for r in rows:
        lead = by_domain.get(r["domain"]) if r["domain"] else None
        if lead is None:
            lead = next((s for key, s in names if alike(r["name_key"], key)), None)
        if lead is None:
            lead = r["seq"]
            merged[lead] = dict(r)
            names.append((r["name_key"], lead))
        else:
            merged[lead] = join_two(merged[lead], r)
        if r["domain"]:
            by_domain.setdefault(r["domain"], lead)
        leader_of[r["seq"]] = lead
    return leader_of, merged


def upsert(state, batch, today):
    """state: list of dicts in id order (with name_key); batch rows with domain, normalized_name, name_key."""
    state = [dict(s) for s in state]
    new = updated = 0
    for p in batch:
        hit = next((s for s in state if p["domain"] and s["domain"] == p["domain"]), None)
        hit = hit or next((s for s in state if alike(p["name_key"], s["name_key"])), None)
        if hit is None:
            fresh = {k: v for k, v in p.items() if k not in ("seq", "scraped_date")}
            fresh |= {"id": max((s["id"] for s in state), default=0) + 1, "tier": p["tier"] or "PARK", "status": "NEW",
                      "first_seen": today, "last_seen": today, "run_count": 1, "status_updated": None, "status_notes": ""}
            state.append(fresh)
            new += 1
            continue
        for c in LIST_COLUMNS:
            hit[c] = union(hit[c], p[c])
        for c in [*FILL_COLUMNS, *CONTACT_COLUMNS]:
            if hit[c] in ("", None, 0) and p[c] not in ("", None, 0):
                hit[c] = p[c]
        hit["domain"] = hit["domain"] or p["domain"]
        hit["last_seen"] = today
        hit["run_count"] += 1
        updated += 1
    return state, new, updated
