"""What workers keep between tasks."""

from tramline.llm.common import held, released


def test_a_worker_keeps_one_operators_state():
    made = []
    make = lambda name: lambda: made.append(name) or name
    assert held("a", 1, make("a1")) == held("a", 1, make("again")) == "a1"
    assert held("a", 2, make("a2")) == "a2" and held("b", 1, make("b1")) == "b1" and held("a", 1, make("a1")) == "a1"
    assert made == ["a1", "a2", "b1", "a1"]


def test_released_runs_batches_and_groups():
    def batches(found):
        for x in found:
            yield x + 1

    assert list(released("c", batches)(iter([1, 2]))) == [2, 3]
    assert released("c", lambda part: part * 2)(4) == 8
    assert held("a", 1, lambda: "new") == "new"  # the other operator's tasks have taken the place
