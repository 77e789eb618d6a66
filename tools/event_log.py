"""Figures per job group from Spark's event log."""

from __future__ import annotations

import glob
import json
import os
from collections import defaultdict


def by_group(folder: str, app_id: str) -> dict[str, dict[str, int]]:
    """Per job group: stages run, tasks, records read from files, records and
    bytes shuffled, and the most shuffle records that one task read."""
    found = glob.glob(os.path.join(folder, f"*{app_id}*"))[0]
    files = sorted(glob.glob(os.path.join(found, "events_*"))) if os.path.isdir(found) else [found]
    group_of: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    seen = set()
    for f in files:
        with open(f) as lines:
            for line in lines:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    for s in e.get("Stage IDs", []):
                        group_of[s] = (e.get("Properties") or {}).get("spark.jobGroup.id") or "-"
                elif e.get("Event") == "SparkListenerTaskEnd":
                    m, g = e.get("Task Metrics") or {}, out[group_of.get(e["Stage ID"], "-")]
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    g["stages"] += (e["Stage ID"],) not in seen
                    seen.add((e["Stage ID"],))
                    g["tasks"] += 1
                    g["records_read"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    g["shuffle_records"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                    g["largest_task"] = max(g["largest_task"], read)
    return out
