from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from loomline.llm import suffix_sort


@pytest.mark.parametrize("chunk", [7, 64, 1 << 19])
def test_order_and_common_prefixes(tmp_path: Path, monkeypatch, chunk: int):
    """Any chunk gives the order of a plain sort up to the cap; small ones force files, runs and merges."""
    monkeypatch.setattr(suffix_sort, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    for trial in range(40):
        parts: list[int] = []
        for _ in range(rng.integers(1, 6)):
            parts += [*rng.integers(1, rng.integers(2, 5), rng.integers(1, 40)).tolist(), 0]
        text = np.array(parts * (1 + trial % 2), np.uint8)
        cap = int(rng.integers(2, 20))
        folder = tmp_path / str(trial)
        folder.mkdir()
        order, common = [], []
        for places, lcp in suffix_sort.SuffixSorter(text, cap, folder).sorted():
            order += places.tolist()
            common += lcp.tolist()
        data = bytes(text)
        assert sorted(order) == list(range(len(data)))
        for i in range(1, len(order)):
            a, b = data[order[i - 1] :][:cap], data[order[i] :][:cap]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert a >= b and common[i] == n


@pytest.mark.parametrize("operator", ["suffix_dedup", "substring_dedup"])
def test_shards_in_files(monkeypatch, operator: str):
    """A shard whose texts lie in a file gives the same as one in memory."""
    import importlib

    from loomline.llm import windows

    module = importlib.import_module(f"loomline.llm.{operator}")
    rng = np.random.default_rng(3)
    units = module.Bytes(20, 4) if operator == "suffix_dedup" else module.Words(5, 2)
    base = " ".join(f"w{i}" for i in rng.integers(0, 50, 60)).encode()
    pieces = [base[int(a) : int(a) + 80] for a in rng.integers(0, 90, 40)] + [base] * 3
    rows = []
    for bucket in range(4):
        own = list(enumerate(pieces))[bucket::4]
        of = lambda kind, values: np.array(values, kind).tobytes()
        keys = [units.key(*units.read(t), 0, len(units.read(t)[1])) for _, t in own]
        rows.append((bucket, of(np.uint64, [7 + i % 2 for i, _ in own]), of(np.uint64, keys), of(np.int64, [i // 2 for i, _ in own]), of(np.int64, [i % 2 * 100 for i, _ in own]), of(np.int64, [len(t) for _, t in own]), b"".join(t for _, t in own)))
    made = []
    for held in (1 << 20, 50):
        monkeypatch.setattr(windows, "HELD_BYTES", held)
        shard = windows.Shard()
        for row in rows:
            shard.add(*row)
        assert (shard.folder is None) == (held > 50)
        made.append([b.to_pylist() for b in shard.settled(module.resolver(units.window, 0 if held == 50 and operator == "suffix_dedup" else 1 << 20))])
    assert made[0] == made[1] and len(made[0]) == 4


def test_a_shard_far_over_its_memory(tmp_path: Path, monkeypatch):
    """The sorter holds a small part of what its text needs, and still finds every repeated window."""
    import tracemalloc

    monkeypatch.setattr(suffix_sort, "CHUNK", 1 << 13)
    monkeypatch.setattr(suffix_sort, "HELD", 1 << 7)
    rng = np.random.default_rng(1)
    peaks = []
    for n in (100_000, 900_000):
        half = rng.integers(1, 5, n).astype(np.uint8)
        text = np.concatenate([half, [0], half[20_000:60_000], [0], rng.integers(1, 5, 100_000).astype(np.uint8), [0]]).astype(np.uint8)
        folder = tmp_path / str(n)
        folder.mkdir()
        text.tofile(folder / "text")
        mapped = np.memmap(folder / "text", np.uint8, "r")
        tracemalloc.start()
        count = repeated = 0
        for places, lcp in suffix_sort.SuffixSorter(mapped, 40, folder).sorted():
            count += len(places)
            repeated += int((lcp >= 40).sum())
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert count == len(text) and repeated == 40_000 - 39
    assert peaks[1] < 3 * len(text) and peaks[1] < 2.5 * peaks[0]  # places and ranks alone would take 16 bytes a symbol
