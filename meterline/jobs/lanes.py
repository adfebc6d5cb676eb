"""Steps that depend on each other, several at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor


def run_in_order(names: list[str], uses: Callable[[str], Iterable[str]], make: Callable[[str], None], lanes: int = 4) -> None:
    """Call ``make`` for every name, each after those of ``names`` that it uses.

    ``names`` is in an order where each one follows what it uses. What uses a failed one isn't made; the others are, and
    then the first failure is raised. Each call submits Spark jobs of its own, so small ones share the cluster.
    """
    steps: dict[str, Future] = {}

    def after_its_inputs(name: str) -> None:
        for used in uses(name):
            if used in steps:
                steps[used].result()
        make(name)

    with ThreadPoolExecutor(lanes) as pool:
        for name in names:
            steps[name] = pool.submit(after_its_inputs, name)
    for step in steps.values():
        step.result()
