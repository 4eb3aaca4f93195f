"""What must not grow with the tables: broadcasts, and pairs inside joins."""


from keycadence.llm import components, neardup, passages

from . import brute


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_near_duplicates_broadcast_nothing(docs, texts, monkeypatch):
    """Small files and arrays look small to Spark, so every join here would broadcast."""
    plans = []
    for module in (neardup, components):
        def kept(rows, label, write=module.materialize):
            plans.append((label, _plan(rows)))
            return write(rows, label)

        monkeypatch.setattr(module, "materialize", kept)
    found = neardup.near_duplicates(docs, width=4)
    plans += [("found", _plan(found)), ("filter", _plan(neardup.dedup_filter(docs, width=4)))]
    assert {"members", "near", "links", "labelled", "open"} <= {label for label, _ in plans}
    assert not [label for label, plan in plans if "Broadcast" in plan]
    wanted = brute.near_components(dict(enumerate(texts)), 4)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: c for i, (_, c) in wanted.items()}


def test_passages_broadcast_nothing(docs, monkeypatch):
    plans = []

    def kept(rows, label, write=passages.materialize):
        plans.append((label, _plan(rows)))
        return write(rows, label)

    monkeypatch.setattr(passages, "materialize", kept)
    plans.append(("filter", _plan(passages.passage_filter(docs))))
    assert {"survivors", "blocks", "members", "open", "often", "checked"} <= {label for label, _ in plans}
    assert not [label for label, plan in plans if "Broadcast" in plan]
