"""Small ledgers for tests, and a sequential fold to check the tables against."""

from __future__ import annotations

import json

from ledgerfold.spec import EVENT_DDL, LedgerSpec


def dumps(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def event(seq, key, kind="scraped", at=None, system=None, source=None, local=None, **rest):
    prov = {
        f: {"extraction_method": m, "model": None, "prompt_version": None, "confidence": None,
            "source_system": s, "pinned": None}
        for f, (m, s) in rest.pop("prov", {}).items()
    }
    row = {
        "seq": seq, "observed_at": at or f"2024-01-{1 + seq // 24 % 28:02d}T{seq % 24:02d}:00:00Z",
        "event_type": kind, "identity_key": key, "source_key": None, "source_id": None,
        "source_system": system, "source": dumps(source or {}), "local": dumps(local or {}),
        "provenance": prov, "discovered_via": [], "notice": None, "actor": None, "note": None,
    }
    if "notice" in rest and rest["notice"] is not None:
        rest["notice"] = dumps(rest["notice"])
    row.update(rest)
    return row


def ledger(spark, rows):
    cols = [c.strip().split(" ")[0] for c in (
        "seq,observed_at,event_type,identity_key,source_key,source_id,source_system,source,"
        "local,provenance,discovered_via,notice,actor,note").split(",")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], EVENT_DDL)


def empty(value):
    return value is None or value == "" or (isinstance(value, (list, dict)) and not value)


def fold(rows, spec: LedgerSpec):
    """State of one identity by walking its events once, in order."""
    blocks, notes, claims, local, prov_s, prov_l, routes = {}, [], {}, {}, {}, {}, []
    seen, last = [], None

    def add(target, items):
        for item in [items] if isinstance(items, str) and items else items or []:
            if dumps(item) not in [dumps(t) for t in target]:
                target.append(item)

    for e in sorted(rows, key=lambda r: (r["observed_at"], r["seq"])):
        kind = e["event_type"]
        if kind in ("scraped", "withdrawn"):
            seen.append(e["observed_at"])
        if kind == "scraped":
            name, last = e["source_system"] or "unknown", e
            for r in e["discovered_via"]:
                if r not in routes:
                    routes.append(r)
            blocks[name] = json.loads(e["source"])
            prov_s = {f: p for f, p in prov_s.items() if p[1] != name}
            for f, p in e["provenance"].items():
                prov_s[f] = (p["extraction_method"], p["source_system"] or name)
            flag = blocks[name].get("withdrawn")
            if flag is True:
                claims[name] = e["observed_at"]
            elif flag is False:
                claims.pop(name, None)
        elif kind == "annotated":
            for f, v in json.loads(e["local"]).items():
                if f in spec.set_fields:
                    local[f] = list(local.get(f, []))
                    add(local[f], v)
                else:
                    local[f] = v
            for f, p in e["provenance"].items():
                prov_l[f] = (p["extraction_method"], p["source_system"])
        elif kind == "withdrawn":
            claims[e["source_system"] or ""] = e["observed_at"]
        else:
            notes.append((kind, e["observed_at"]))

    source = {}
    for name in sorted(blocks, key=lambda s: (spec.precedence.get(s, 500), s), reverse=True):
        for f, v in blocks[name].items():
            if f in spec.set_fields:
                source.setdefault(f, [])
                add(source[f], v)
            elif f == "extra" and isinstance(v, dict):
                source[f] = {**source.get(f, {}), **{k: x for k, x in v.items() if not empty(x)}}
            elif not empty(v) or f not in source:
                source[f] = v
    effective = {}
    for f in {*source, *local}:
        s, l = source.get(f), local.get(f)
        if f in spec.set_fields:
            effective[f] = []
            add(effective[f], s)
            add(effective[f], l)
        elif not empty(s):
            effective[f] = s
            if not empty(l) and l != s:
                notes.append(("displacement", f))
        elif l is not None:
            effective[f] = l
    return {
        "effective": {f: dumps(v) for f, v in effective.items() if not (f in spec.set_fields and not v)},
        "provenance": {**prov_l, **prov_s},
        "withdrawn_at": min(claims.values()) if claims else None,
        "first_seen": seen[0] if seen else None,
        "last_seen": seen[-1] if seen else None,
        "systems": sorted(blocks),
        "last": (last["source_key"], last["source_system"]) if last else (None, None),
        "count": len(rows),
        "routes": routes,
        "notes": sorted(notes),
    }
