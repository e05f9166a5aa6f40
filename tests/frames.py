"""Literal frames for the rule tests."""

import json


def state(entity, value, *, updated="2023-03-07T06:15:42.481207+00:00",
          changed="2023-03-07T05:02:11.130954+00:00", reported=True, attrs=None, ctx="c1"):
    s = {"entity_id": entity, "state": value, "attributes": attrs or {},
         "last_changed": changed, "last_updated": updated,
         "context": {"id": ctx, "parent_id": None, "user_id": None}}
    if reported:
        s["last_reported"] = updated
    return s


def frame(new, old, *, data_entity=None, event_type="state_changed", fid=1, ftype="event"):
    ent = data_entity if data_entity is not None else (new or old or {}).get("entity_id", "x.y")
    f = {"type": ftype, "event": {
        "event_type": event_type, "time_fired": "2023-03-07T06:15:42.481207+00:00",
        "origin": "LOCAL", "context": {"id": "c0", "parent_id": None, "user_id": None},
        "data": {"entity_id": ent, "old_state": old, "new_state": new}}}
    if fid is not None:
        f["id"] = fid
    return json.dumps(f)


# A sensor frame with invented values: the data entity differs from the new
# state's entity, attributes are nested.
SAMPLE_ATTRS = {"limit": None, "load": 7.25, "maker": {"name": "TX-40", "rev": 2},
                "stale": False, "unit": "°C"}
SAMPLE = frame(
    state("sensor.boiler_return", "31", attrs=SAMPLE_ATTRS, ctx="new"),
    state("sensor.boiler", "31", updated="2023-03-07T06:15:30.902416+00:00",
          attrs=SAMPLE_ATTRS, ctx="old"),
    data_entity="sensor.boiler")
