"""Plain-Python sequential evaluation of the apply semantics, used as the test oracle."""

OUT = ("SALE", "DAMAGE", "WASTE")
IN = ("PURCHASE", "RETURN")
TYPES = ("PURCHASE", "SALE", "DAMAGE", "ADJUSTMENT", "RETURN", "WASTE")


def sign(event_type, q):
    if q == 0:
        return None, "Quantity cannot be zero"
    if event_type in IN + OUT and q < 0:
        return None, f"{event_type} quantity must be positive"
    if event_type not in TYPES:
        return None, "Unsupported event type"
    return (-q if event_type in OUT else q), None


def apply_sequential(events, recipes=(), log_ids=(), start=None):
    """events: dicts org, product_id, event_id, event_type, quantity, seq (any order).
    recipes: dicts org, finished_product_id, component_product_id, quantity, recipe_item_id.
    Returns ({(org, seq): (status, error)}, {(org, product): balance})."""
    bal = dict(start or {})
    recorded = set(log_ids)
    out = {}
    by_dish = {}
    for r in sorted(recipes, key=lambda r: r["recipe_item_id"]):
        by_dish.setdefault((r["organization_id"], r["finished_product_id"]), []).append(r)
    for e in sorted(events, key=lambda e: e["seq"]):
        org = e["organization_id"]
        key = (org, e["event_id"])
        if key in recorded:
            out[(org, e["seq"])] = ("success", None)
            continue
        delta, err = sign(e["event_type"], e["quantity"])
        if err:
            out[(org, e["seq"])] = ("failed", err)
            continue
        steps = [(e["product_id"], delta, e["event_type"] in OUT, e["event_id"])]
        if e["event_type"] == "SALE":
            for r in by_dish.get((org, e["product_id"]), []):
                c = r["component_product_id"]
                steps.append((c, -r["quantity"] * e["quantity"], True, f"{e['event_id']}:component:{c}"))
        tent = {}
        ok = True
        new_ids = []
        for i, (p, d, guarded, eid) in enumerate(steps):
            if i > 0 and (org, eid) in recorded:
                continue
            cur = tent.get((org, p), bal.get((org, p), 0))
            if guarded and cur + d < 0:
                ok = False
                break
            tent[(org, p)] = cur + d
            new_ids.append((org, eid))
        if ok:
            bal.update(tent)
            recorded.update(new_ids)
            out[(org, e["seq"])] = ("success", None)
        else:
            out[(org, e["seq"])] = ("failed", "Insufficient inventory")
    return out, bal
