"""Small workflow documents, written for the tests."""

from __future__ import annotations

import json


def node(ident, command, content="", reads=(), writes=(), after=(), **more):
    out = {
        "id": ident,
        "name": f"step_{ident}",
        "script": {"runtime": {"command": command}, "content": content},
        "inputs": {
            "tables": [{"guid": g} for g in reads],
            "nodeOutputs": [{"data": a} for a in after],
        },
        "outputs": {"tables": [{"guid": g} for g in writes]},
    }
    out.update(more)
    return out


def flow_of(nodes):
    return [
        {"nodeId": n["id"], "depends": [{"nodeId": r["data"], "type": "Normal"} for r in n["inputs"]["nodeOutputs"]]}
        for n in nodes
    ]


def workflow(name, nodes, ident=None, cron="00 02 00 * * ?", variables=(("bizdate", "System", "${bizdate}"),), flow=None):
    return {
        "id": ident or name,
        "name": name,
        "trigger": {"cron": cron, "timezone": "UTC"},
        "variables": [{"name": n, "type": t, "value": v} for n, t, v in variables],
        "nodes": nodes,
        "flow": flow_of(nodes) if flow is None else flow,
    }


def document(*workflows):
    return {"kind": "CycleWorkflow", "spec": {"name": workflows[0]["name"], "id": workflows[0]["id"], "workflows": list(workflows)}}


def weather():
    """Five nodes listed against their flow: two writers of one table, two outputs of one node, one node without id.

    Flow: fetch, then clean and early, then late; audit stands alone.  Two of
    them write ``rain``: ``early`` runs first, but ``late`` is listed first.
    """
    return workflow(
        "weather",
        [
            node("late", "ODPS_SQL", "SET limit = 5\nINSERT INTO TABLE rain SELECT /*+ MAPJOIN(s) */ s.place, s.mm FROM cleaned s;",
                 reads=["m.w.cleaned"], writes=["m.w.rain"], after=["clean", "early"]),
            node("early", "ODPS_SQL", "with wet as (select 1) INSERT OVERWRITE TABLE rain SELECT place, mm FROM gauges LATERAL VIEW explode(mms) t AS mm;",
                 reads=["m.w.gauges"], writes=["m.w.rain"], after=["fetch"]),
            node("clean", "ODPS_SQL", "# DATEADD( is not called here\nINSERT OVERWRITE TABLE cleaned SELECT place, mm FROM raw WHERE mm >= 0;",
                 reads=["m.w.raw"], writes=["m.w.cleaned", "m.w.cleaned_copy"], after=["fetch"]),
            node("fetch", "DIDE_SHELL", "curl http://stations"),
            node("", "PYODPS", "print('no id')"),
            node("audit", "PYODPS", "print('seen')"),
        ],
        cron="00 15 04 * * ?",
        variables=(("bizdate", "System", "${bizdate}"), ("station", "Custom", "north")),
    )


def library():
    """Seven nodes: a circle of two, a node below it, and a diamond beside them."""
    day = "PARTITION (pt='${bizdate}')"
    return workflow(
        "library",
        [
            node("top", "VIRTUAL"),
            node("left", "ODPS_SQL", f"INSERT OVERWRITE TABLE loans {day} SELECT reader, book FROM desk_log WHERE branch = '${{branch}}';",
                 ["l.desk_log"], ["l.loans"], ["top"]),
            node("right", "ODPS_SQL", f"INSERT OVERWRITE TABLE returns {day} SELECT book, NVL(days, 0) FROM box_log;",
                 ["l.box_log"], ["l.returns"], ["top"]),
            node("bottom", "ODPS_SQL", f"INSERT OVERWRITE TABLE shelf {day} SELECT l.book FROM loans l JOIN returns r ON l.book = r.book;",
                 ["l.loans", "l.returns"], ["l.shelf"], ["left", "right"]),
            node("ring_a", "PYODPS", "frame.groupby('k')", after=["ring_b"]),
            node("ring_b", "PYODPS", "print(1)", after=["ring_a"]),
            node("below", "VIRTUAL", after=["ring_b"]),
        ],
        variables=(("bizdate", "System", "${bizdate}"), ("branch", "Custom", "east")),
    )


def frame(spark, docs):
    from weirstone.sources.documents import parse_documents

    rows = [(f"doc_{i:03d}.json", json.dumps(d)) for i, d in enumerate(docs)]
    return parse_documents(spark.createDataFrame(rows, "source_file string, value string"), "value", "source_file")
