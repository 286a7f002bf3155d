"""Named stages in order; a failing stage ends the run and names itself."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Pipeline:
    stages: list[tuple[str, Callable[[dict], object]]] = field(default_factory=list)

    def stage(self, name: str):
        def add(f: Callable[[dict], object]):
            self.stages.append((name, f))
            return f

        return add

    def run(self, start: str | None = None) -> dict:
        """Results by stage; ``start`` skips the stages before it."""
        names = [n for n, _ in self.stages]
        results: dict = {}
        for name, f in self.stages[names.index(start) if start else 0 :]:
            try:
                results[name] = f(results)
            except Exception as e:
                raise RuntimeError(f"stage {name} failed") from e
        return results
