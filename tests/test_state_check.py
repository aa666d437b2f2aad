"""A damaged checkpoint is found before a query restarts from it."""

import os
import shutil

import pytest
from conftest import meta, trade

from barforge.session import fresh_dir
from barforge.sources.topic import RAW_SCHEMA
from barforge.streaming import bars, late, lifecycle, state_check

T0 = 1704067200000


@pytest.fixture(scope="module")
def checkpoints(spark):
    """A windowed aggregate's and a timer operator's checkpoint after two batches."""
    from conftest import make_raw
    root = fresh_dir(spark, "statecheck").removeprefix("file://")
    src = os.path.join(root, "raw")
    for n in range(2):
        make_raw(spark, [(meta(T0 + n), trade(t=10 * n + i, T=T0 + n * 60000 + i)) for i in range(5)]).write.mode("append").parquet(src)
        stream = spark.readStream.schema(RAW_SCHEMA).parquet(src)
        bars.write_bars_final(bars.stream_bars(stream, "2 minutes"), f"{root}/bars", f"{root}/chk-bars",
                              trigger={"availableNow": True}).awaitTermination()
        late.write_closed_minutes(late.laned_trades(stream, "2 minutes"), f"{root}/late", f"{root}/chk-late",
                                  trigger={"availableNow": True}).awaitTermination()
    return root


def _copy(checkpoints, name):
    to = f"{checkpoints}/copy-{name}-{len(os.listdir(checkpoints))}"
    shutil.copytree(f"{checkpoints}/{name}", to)
    return to


def _cut(path, text=""):
    """Overwrite a file behind its checksum's back."""
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize("name", ["chk-bars", "chk-late"])
def test_sound_and_new_checkpoints_have_no_problems(spark, checkpoints, name):
    assert state_check.checkpoint_problems(spark, f"{checkpoints}/{name}") == []
    assert state_check.checkpoint_report(spark, f"{checkpoints}/absent").count() == 0


@pytest.mark.parametrize("part", ["metadata", "offsets", "commits"])
def test_damaged_logs_are_refused(spark, checkpoints, part):
    chk = _copy(checkpoints, "chk-bars")
    folder = os.path.join(chk, part)
    path = folder if part == "metadata" else os.path.join(folder, max((f for f in os.listdir(folder) if f.isdigit()), key=int))
    _cut(path, "v1\n{")
    assert part in {p for p, _ in state_check.checkpoint_problems(spark, chk)}
    started = []
    with pytest.raises(state_check.DamagedCheckpoint):
        lifecycle.recover(spark, "no-such-query", lambda: started.append(1), lambda q: None, chk)
    assert started == []


def test_lost_batches_and_lost_state_are_refused(spark, checkpoints):
    chk = _copy(checkpoints, "chk-bars")
    last = max((f for f in os.listdir(f"{chk}/offsets") if f.isdigit()), key=int)
    os.unlink(f"{chk}/offsets/{last}")
    if int(last) > 1:
        os.unlink(f"{chk}/offsets/{int(last) - 1}")
    assert "offsets" in {p for p, _ in state_check.checkpoint_problems(spark, chk)}
    for name in ("chk-bars", "chk-late"):
        chk = _copy(checkpoints, name)
        for folder, _, files in os.walk(f"{chk}/state"):
            for f in files:
                if f.endswith((".delta", ".zip", ".changelog", ".snapshot")):
                    os.unlink(os.path.join(folder, f))
        assert "state" in {p for p, _ in state_check.checkpoint_problems(spark, chk)}
