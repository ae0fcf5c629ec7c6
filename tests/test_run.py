import argparse
from datetime import date

import pytest

from tramline import run


def test_both_spellings_of_a_day():
    assert run.day("2024-01-12") == run.day(" 20240112 ") == date(2024, 1, 12)
    for text in ("2024-0112", "24-01-12", "2024-02-30", "20241301", "today", ""):
        with pytest.raises(argparse.ArgumentTypeError):
            run.day(text)


def called(monkeypatch, *names):
    calls = []
    for name in names:
        monkeypatch.setattr(run.daily, name, lambda *a, name=name: calls.append((name, *a[1:])) or True)
    monkeypatch.setattr(run, "build_session", lambda name: name)
    monkeypatch.setattr(run.daily, "Warehouse", lambda session, base: base)
    return calls


def test_steps_call_the_library(monkeypatch):
    calls = called(monkeypatch, "nightly", "load_schedule", "load_raw", "build_facts", "build_marts")
    first, last = date(2024, 1, 1), date(2024, 1, 3)
    assert run.main("nightly --warehouse w --snapshots s --schedules d --date 20240112".split()) == 0
    assert run.main("schedule --warehouse w --schedules d".split()) == 0
    assert run.main("raw --warehouse w --snapshots s --feed alerts --first 20240101 --last 2024-01-03 --stride 5".split()) == 0
    assert run.main("build --warehouse w --first 20240101 --last 20240103".split()) == 0
    assert calls == [("nightly", "s", "d", date(2024, 1, 12)), ("load_schedule", "d", None), ("load_raw", "s", "alerts", first, last, 5),
                     ("build_facts", first, last), ("build_marts", first, last)]
    calls.clear()
    assert run.main("backfill --warehouse w --snapshots s --schedules d --first 20240101 --last 20240103".split()) == 0
    assert [c[0] for c in calls] == ["load_schedule", "load_raw", "load_raw", "load_raw", "build_facts", "build_marts"]


def test_wrong_arguments_end_with_a_message(monkeypatch, capsys):
    called(monkeypatch)
    for wrong in ("nightly --warehouse w", "build --warehouse w --first 20240104 --last 20240103", "raw --warehouse w --snapshots s --feed x --first 20240101 --last 20240101",
                  "build --warehouse w --first 2024 --last 20240103"):
        with pytest.raises(SystemExit) as end:
            run.main(wrong.split())
        assert end.value.code == 2
    assert "no day" in capsys.readouterr().err


def test_no_schedule_is_told_by_the_exit_code(monkeypatch):
    called(monkeypatch, "load_schedule")
    monkeypatch.setattr(run.daily, "load_schedule", lambda *a: False)
    assert run.main("schedule --warehouse w --schedules d --date 2024-01-05".split()) == 1
