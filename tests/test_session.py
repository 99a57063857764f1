"""Cluster defaults never override the session's own settings, and the
checkpoint folder is the one the session names."""

from roadlens.session import CLUSTER_DEFAULTS, apply_cluster_defaults, checkpoint_root, ensure_checkpoint_dir


def test_cluster_defaults_fill_only_unset_keys(spark):
    before = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    try:
        apply_cluster_defaults(spark)
        for k, v in CLUSTER_DEFAULTS.items():
            assert spark.conf.get(k) == (before[k] if before[k] not in (None, "") else v), k
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # set by the test session
    finally:
        for k, v in before.items():
            if v in (None, ""):
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_checkpoint_folder_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == d  # no new folder on a second call
    assert checkpoint_root(spark) == d.rstrip("/")


def test_a_cluster_without_shared_folder_is_refused():
    """Executors of their own can't see a folder the driver makes up."""
    from types import SimpleNamespace

    import pytest

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_workers_find_the_package_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from roadlens.session import build_session\n"
        "s = build_session('local[2]', 2)\n"
        "def f(batches):\n"
        "    import os, roadlens.schemas\n"
        "    for b in batches:\n        yield b\n"
        "print('ROWS', s.range(3).mapInArrow(f, 'id long').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, env=env, cwd=tmp_path)
    assert "ROWS 3" in got.stdout, got.stderr[-2000:]
