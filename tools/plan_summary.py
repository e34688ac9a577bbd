"""Summarise the physical plan of every registered job into PLANS.md.

Usage: python tools/plan_summary.py [sf_dir] [out.md]
For each job (batch jobs only; the stream is described by hand): the
shuffles with their partitioning, joins and their strategy, aggregates,
windows and top-k nodes, and each Parquet scan's pushed filters and read
schema, taken from the executed plan after one run (AQE's final plan).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def clean(s: str) -> str:
    return re.sub(r"#\d+L?", "", s)


def final_only(plan: str) -> list[str]:
    """Lines of an AQE plan without its "Initial Plan" blocks (also nested ones)."""
    lines: list[str] = []
    for line in plan.splitlines():
        # an expression holding a line break continues on a line of its own
        if lines and line.lstrip().startswith(","):
            lines[-1] += "\\n" + line
        else:
            lines.append(line)
    kept, skip_col = [], None
    for line in lines:
        col = len(line) - len(line.lstrip())
        if skip_col is not None:
            if col > skip_col:
                continue
            skip_col = None
        if "== Initial Plan ==" in line:
            skip_col = col
            continue
        kept.append(line)
    return kept


def summarise(plan: str) -> dict:
    out = {"exchanges": [], "joins": [], "scans": [], "ops": []}
    for line in final_only(plan):
        body = line.strip(" :+-|")
        body = re.sub(r"^\*\(\d+\)\s*", "", body)
        if body.startswith("Exchange"):
            out["exchanges"].append(clean(body.split(", ENSURE")[0].split(", REPARTITION")[0]))
        elif "ReusedExchange" in body:
            out["exchanges"].append("(reused exchange)")
        elif re.match(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", body):
            m = re.match(r"(\w+) (\[.*?\]), (\[.*?\]), (\w+)", body)
            out["joins"].append(clean(" ".join(m.groups())) if m else clean(body[:80]))
        elif body.startswith("FileScan parquet") or body.startswith("FileScan text"):
            loc = re.search(r"\[file:[^\],]*?/([^/\],]+)(?:\]|,)", body)
            pf = re.search(r"PushedFilters: (\[.*?\])", body)
            part = re.search(r"PartitionFilters: (\[.*?\])", body)
            rs = re.search(r"ReadSchema: (struct<.*?>)", body)
            kind = "text " if body.startswith("FileScan text") else ""
            pruned = f", partition filters {clean(part.group(1))}" if part and part.group(1) != "[]" else ""
            out["scans"].append(f"{kind}{loc.group(1) if loc else '?'}: pushed {pf.group(1) if pf else '[]'}"
                                f"{pruned}, reads {rs.group(1) if rs else '?'}")
        else:
            for op in ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "WindowGroupLimit",
                       "TakeOrderedAndProject", "Generate", "Union", "Expand"):
                if body.startswith(op + "(") or body.startswith(op + " "):
                    out["ops"].append(op)
    return out


NOTES = {
    "line_count": "One partial sum per task, one row shuffled per task.",
    "dated_line_count": "Day folders are chosen by name before anything is listed below them; the count "
                        "is one partial aggregate per task.",
    "word_count": "Tokenised in the scan's tasks; partial count per task, so a word with a third of all "
                  "occurrences ships one row per task.",
    "word_count_topk": "As word_count, then TakeOrderedAndProject keeps k rows per task; the rank "
                       "window sees k rows.",
    "value_share": "One scan for any number of wanted values; at most one row per value and task shuffled.",
    "affected_share": "Status filter pushed into the scan; status ids deduplicated map-side before the "
                      "join, so a hot id cannot multiply rows; per-address flag aggregate, then totals.",
    "topk_share": "Partial count per key; the total is a scalar subquery (count(*) with no column read).",
    "anagram_groups": "Tokens deduplicated (partial) before the anagram key is computed; tokens alone under "
                      "their key are dropped by a partial count before lists are gathered.",
    "anagram_members": "As anagram_groups, but nothing is gathered.",
    "pair_digest_match": "One digest per candidate, semi join on distinct digests; no pair product.",
    "option_expand": "explode in place: no shuffle.",
    "trailing_topn_avg": "Time bound pushed to Parquet; WindowGroupLimit keeps n rows per key and task "
                         "before the shuffle.",
    "cheapest_under_limit": "One scan of the longer window, bounded per key and task before the shuffle; "
                            "per-group argmin is an aggregate.",
    "choice_severity": "Distinct event types joined with the preference list; no window.",
    "ttl_exclude": "One sequence of candidates and exclusions, range-partitioned and written once (not "
                   "shown: the plan below reads it); chunks follow row counts, so a hot key is split "
                   "wherever its rows fall; one row per key and chunk is carried on.",
    "failure_streak": "As ttl_exclude: chunks by row counts, running counts per (key, chunk), a table of "
                      "one row per key and chunk windowed per key, and a join back.",
    "failure_streak_health": "As failure_streak; chunks are walked row by row in Python, twice.",
}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    dest = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(__file__), "..", "PLANS.md")
    from tessera.session import build_session
    from tessera.plans import REGISTRY

    spark = build_session("local[8]", shuffle_partitions=8)
    lines = ["# Physical plans of the registered jobs", "",
             f"Generated by `tools/plan_summary.py` from the final (AQE) plans at `{sf_dir}`, `local[8]`.",
             "Static broadcast choices here reflect the small test tables; at scale the same",
             "joins plan as sort-merge joins unless measured sizes stay under the broadcast threshold.", ""]
    for name, fn in REGISTRY.items():
        if name == "word_count_stream":
            continue
        df = fn(spark, sf_dir)
        df.collect()  # runs this DataFrame's own plan, so AQE's final plan is shown
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        lines.append(f"## {name}")
        lines.append("")
        lines.append(f"- shuffles ({len(s['exchanges'])}): " + ("; ".join(s["exchanges"]) or "none"))
        lines.append("- joins: " + ("; ".join(s["joins"]) or "none"))
        ops = {}
        for o in s["ops"]:
            ops[o] = ops.get(o, 0) + 1
        lines.append("- operators: " + (", ".join(f"{k}×{v}" for k, v in ops.items()) or "none"))
        for sc in s["scans"]:
            lines.append(f"- scan {sc}")
        if name in NOTES:
            lines.append(f"- at scale: {NOTES[name]}")
        lines.append("")
    lines += ["## word_count_stream", "",
              "- file stream source over the documents Parquet file → partial count per task → shuffle on "
              "`word` into the RocksDB state store (one row per word) → `foreachBatch` writes changed "
              "counts into a folder per batch, merged every ten batches; the read takes the latest "
              "snapshot and the latest row per word of the batches after it.", ""]
    with open(dest, "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()
    print(f"wrote {os.path.abspath(dest)}")


if __name__ == "__main__":
    main()
