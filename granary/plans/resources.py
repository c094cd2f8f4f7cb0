"""How many workers a machine should run, and the choice among plans by a measured sample."""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from granary.operators.infer import WorkerSpec, run_to_folder
from granary.sources.files import write_metrics

# Shares and sizes of the sizing rule.
VRAM_SHARE, RAM_SHARE = 0.85, 0.7
SEQ_MB_PER_TOKEN, SEQ_MB_BASE, SEQ_MB_LEAST = 0.06, 40, 60
WEIGHT_COPIES = 1.6
UNKNOWN_WEIGHTS_MIB = 1000.0


@dataclass
class Cpu:
    logical: int = 1
    physical: int = 1
    model: str = ""


@dataclass
class Ram:
    total_mb: int = 0
    available_mb: int = 0


@dataclass
class Gpu:
    present: bool = False
    backend: bool = False
    vram_total_mb: int = 0
    vram_free_mb: int = 0


@dataclass
class Resources:
    cpu: Cpu = field(default_factory=Cpu)
    ram: Ram = field(default_factory=Ram)
    gpu: Gpu = field(default_factory=Gpu)
    disk_free_mb: int = 0


GPU_FIELDS = {"memory.total": "gpu_vram_total_mb", "memory.free": "gpu_vram_free_mb", "memory.used": "gpu_vram_used_mb", "utilization.gpu": "gpu_util_pct", "power.draw": "gpu_power_w", "temperature.gpu": "gpu_temp_c"}


def gpu_numbers(ask: Callable[[list[str]], str] | None = None) -> dict[str, float | None]:
    """Figures of the first GPU by the vendor's command, {} where it can't be asked; a figure that it can't tell is None."""

    def run(command: list[str]) -> str:
        import subprocess

        return subprocess.run(command, capture_output=True, text=True, timeout=5, check=True).stdout

    try:
        line = (ask or run)(["nvidia-smi", f"--query-gpu={','.join(GPU_FIELDS)}", "--format=csv,noheader,nounits"]).strip().splitlines()[0]
    except Exception:
        return {}

    def number(x: str) -> float | None:
        try:
            return float(x)
        except ValueError:
            return None

    return dict(zip(GPU_FIELDS.values(), (number(x.strip()) for x in line.split(","))))


def probe(ask: Callable[[list[str]], str] | None = None, backend: bool = False) -> Resources:
    """This machine; ``backend`` tells whether a GPU backend is installed."""
    import psutil

    memory, seen = psutil.virtual_memory(), gpu_numbers(ask)
    gpu = Gpu(bool(seen), bool(seen) and backend, int(seen.get("gpu_vram_total_mb") or 0), int(seen.get("gpu_vram_free_mb") or 0))
    return Resources(Cpu(psutil.cpu_count() or 1, psutil.cpu_count(logical=False) or 1), Ram(memory.total >> 20, memory.available >> 20), gpu, psutil.disk_usage("/").free >> 20)


def weights_mib(model_path: str) -> float:
    try:
        return os.stat(model_path).st_size / (1 << 20)
    except OSError:
        return UNKNOWN_WEIGHTS_MIB


def plan_workers(machine: Resources, model_path: str, ctx_per_seq: int = 1536, max_parallel: int = 12, threads_each: int = 2, reserve: int = 2, gpu_threads: int = 2, max_cpu_workers: int | None = None, max_vram_mb: int | None = None) -> list[WorkerSpec]:
    """A GPU worker if there is a GPU with a backend, and CPU workers as threads and memory allow.

    The GPU worker runs as many sequences at once as its memory holds beside the weights (1 to
    ``max_parallel``). CPU workers: ``max_cpu_workers`` (0 counts) or the free threads by ``threads_each``, at
    most as many as copies of the weights fit into the available memory.
    """
    weights = weights_mib(model_path)
    plan: list[WorkerSpec] = []
    gpu = machine.gpu
    if gpu.present and gpu.backend:
        free = gpu.vram_free_mb if gpu.vram_free_mb > 0 else gpu.vram_total_mb
        free = min(free, max_vram_mb) if max_vram_mb else free
        each = max(SEQ_MB_LEAST, int(ctx_per_seq * SEQ_MB_PER_TOKEN) + SEQ_MB_BASE)
        fit = int((free * VRAM_SHARE - weights) // each)
        plan.append(WorkerSpec("gpu", "gpu0", gpu_threads, max(1, min(max_parallel, fit)), ctx_per_seq))
    if threads_each > 0:
        spare = max(0, machine.cpu.logical - gpu_threads * len(plan) - reserve)
        wanted = spare // threads_each if max_cpu_workers is None else max_cpu_workers
        fit = int(machine.ram.available_mb * RAM_SHARE // (weights * WEIGHT_COPIES))
        plan += [WorkerSpec("cpu", f"cpu{i}", threads_each) for i in range(max(0, min(wanted, fit)))]
    return plan


def calibrate(machine: Resources, model_path: str, rate: Callable[[list[WorkerSpec]], float], has_sample: bool = True, ctx_per_seq: int = 2048) -> list[WorkerSpec]:
    """The plan of 0, 1 and 2 CPU workers beside the GPU with the highest measured ``rate``; ties go to the first.

    A plan that fails or is empty is passed over; if all are, the plan without CPU workers. Without a sample, the
    sizing rule alone.
    """
    if not has_sample:
        return plan_workers(machine, model_path, ctx_per_seq)
    best, top = None, 0.0
    for n in range(3):
        plan = plan_workers(machine, model_path, ctx_per_seq, max_cpu_workers=n)
        if not plan:
            continue
        try:
            r = rate(plan)
        except Exception:  # a plan that can't run isn't a candidate
            continue
        if r > top:
            best, top = plan, r
    return best if best is not None else plan_workers(machine, model_path, ctx_per_seq, max_cpu_workers=0)


class Monitor:
    """Samples of this machine's load once an ``interval``, as rows of the metrics table; written as CSV to ``path`` at the end."""

    def __init__(self, interval: float = 1.0, path: str | None = None) -> None:
        self.interval, self.path, self.rows, self._stop = interval, path, [], threading.Event()
        self._thread: threading.Thread | None = None

    def _run(self) -> None:
        import psutil

        began = time.monotonic()
        while not self._stop.wait(self.interval):
            m = psutil.virtual_memory()
            self.rows.append({"t": round(time.monotonic() - began, 3), "cpu_pct": psutil.cpu_percent(), "cpu_logical": psutil.cpu_count(), "ram_used_mb": m.used >> 20, "ram_avail_mb": m.available >> 20} | gpu_numbers())

    def __enter__(self) -> Monitor:
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()
        if self.path:
            write_metrics(self.rows, self.path)


def compare_mixes(spark, jobs, mixes: dict[str, WorkerSpec], folder: str, backend) -> list[dict]:
    """Run the same jobs once for each mix of workers: name, jobs, ok_pct, elapsed_s, jobs_per_s, in order of the rate."""
    rows = [{"name": name, **run_to_folder(spark, jobs, f"{folder}/{name}", backend, spec, max(1, spec.n_threads))} for name, spec in mixes.items()]
    return sorted(rows, key=lambda r: -r["jobs_per_s"])


def run_planned(spark, jobs, folder: str, backend, model_path: str = "", machine: Resources | None = None, sample: int = 60) -> dict:
    """Look at the machine, choose among its plans by the rate of the first ``sample`` jobs, and run all jobs by the best one.

    A worker of the plan is a partition that runs at a time. Without a plan (no memory, no threads) one worker runs.
    """
    first = jobs.where(jobs["_idx"] < sample)

    def rate(plan: list[WorkerSpec]) -> float:
        name = "-".join(w.name for w in plan)
        return float(run_to_folder(spark, first, f"{folder}/calibration/{name}", backend, plan[0], len(plan))["jobs_per_s"])

    plan = calibrate(machine or probe(), model_path, rate, bool(first.limit(1).count())) or [WorkerSpec("cpu", "cpu0")]
    return run_to_folder(spark, jobs, folder, backend, plan[0], len(plan), plan)


if __name__ == "__main__":
    import json
    from dataclasses import asdict

    print(json.dumps(asdict(probe()), indent=2))
