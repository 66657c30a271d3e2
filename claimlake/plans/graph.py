"""Specifications as a graph: read from files in any order, run in the order of what they read, refreshed with all that depends on them.

What a specification reads is its ``table``, and every table of the graph that its ``sql`` names. A refresh computes a table and
everything below it anew beside what is there, from the rest as it stands; only when all of it is whole does one small file make
it current. A run that fails before leaves everything as it was.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from claimlake.plans.flows import FlowRunner, FlowSpec, load_specs
from claimlake.sources.paths import children, exists, publish_text, read_text


def read_specs(spark: SparkSession, folder: str, tokens: Mapping[str, str] | None = None, pattern: str = "*.json") -> list[FlowSpec]:
    """The specifications of all files below a folder; a file holds one or a list of them."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    named = files.select("value", F.col("_metadata.file_path").alias("path")).orderBy("path").collect()
    specs = []
    for row in named:
        text = row.value.strip()
        try:
            specs += load_specs(text if text.startswith("[") else f"[{text}]", tokens)
        except (TypeError, ValueError, KeyError) as error:
            raise ValueError(f"{row.path}: {error}") from error
    return specs


class FlowGraph:
    """Specifications by the name of their table, and what each of them reads."""

    def __init__(self, specs: Iterable[FlowSpec]) -> None:
        self.specs: dict[str, FlowSpec] = {}
        for spec in specs:
            if spec.view in self.specs:
                raise ValueError(f"two specifications make {spec.view}")
            self.specs[spec.view] = spec
        self.reads = {name: self._inputs(spec) for name, spec in self.specs.items()}
        try:
            self.order = list(TopologicalSorter({n: sorted(self.reads[n]) for n in sorted(self.specs)}).static_order())
        except CycleError as error:
            raise ValueError(f"tables that wait for each other: {' <- '.join(error.args[1])}") from None

    def _inputs(self, spec: FlowSpec) -> set[str]:
        base = lambda name: name if name in self.specs else name.removesuffix("_quarantine")
        if spec.table:
            if base(spec.table) not in self.specs:
                raise ValueError(f"{spec.view} reads {spec.table}, which no specification makes")
            return {base(spec.table)}
        words = set(re.findall(r"\w+", spec.sql))
        return {base(w) for w in words if base(w) in self.specs and base(w) != spec.view}

    def below(self, *names: str) -> list[str]:
        """Tables and everything that depends on them, in the order of a run."""
        unknown = [n for n in names if n not in self.specs]
        if unknown:
            raise ValueError(f"no specification makes {unknown}")
        found = set(names)
        for name in self.order:
            if self.reads[name] & found:
                found.add(name)
        return [n for n in self.order if n in found]


class GraphRunner:
    """A graph below one root folder, which all executors must reach; one runner at a time works on it."""

    def __init__(self, spark: SparkSession, root: str, graph: FlowGraph) -> None:
        self.spark, self.root, self.graph = spark, root.rstrip("/"), graph
        self.flows = FlowRunner(spark, self.root, roots=self._current())
        for name in graph.order:
            spec = graph.specs[name]
            if exists(spark, self.flows.path(spec)):
                self.flows.adopt(spec)

    def _generations(self) -> list[str]:
        return [n for n in children(self.spark, f"{self.root}/generations") if n.endswith(".json") and not n.startswith(".")]

    def _current(self) -> dict[str, str]:
        """Where the tables lie that were refreshed; the others lie below the root."""
        known = self._generations()
        return json.loads(read_text(self.spark, f"{self.root}/generations/{known[-1]}")) if known else {}

    def run(self) -> FlowRunner:
        """Run everything in order; streams take what is new."""
        self._run(self.graph.order)
        return self.flows

    def refresh(self, *names: str) -> list[str]:
        """Compute tables and all below them from scratch and make the result current; the tables that were computed."""
        due = self.graph.below(*names)
        before = dict(self.flows.roots)
        fresh = f"{self.root}/refresh-{uuid.uuid4().hex[:12]}"
        self.flows.roots.update(dict.fromkeys(due, fresh))
        try:
            self._run(due)
            number = len(self._generations()) + 1
            if not publish_text(self.spark, f"{self.root}/generations/{number:08d}.json", json.dumps(self.flows.roots)):
                raise RuntimeError(f"{self.root}: another runner has made a generation {number}")
        except BaseException:
            self.flows.roots.clear()
            self.flows.roots.update(before)
            for name in due:
                self.flows.adopt(self.graph.specs[name])
            raise
        return due

    def _run(self, names: Sequence[str]) -> None:
        self.flows.run([self.graph.specs[n] for n in names])
