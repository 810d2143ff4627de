"""Environments by name: how one kind of benchmark reads its tasks, grades a finished run and takes the patch from it.

A finished run is columns (exit_code, log, diff, answer ..); grading and patches are column expressions, so one plan
grades the rows of all environments.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions import text
from rollweave.sources import files


def pytest_breakdown(run: dict[str, Column]) -> Column:
    """score, tests passed and tests in all, from the test run's log; a log without counts scores 0."""
    found = text.pytest_result(run["log"])
    return F.create_map(F.lit("score"), found["score"], F.lit("tests_passed"), found["passed"].cast("double"), F.lit("tests_total"), found["total"].cast("double"))


def git_diff(run: dict[str, Column]) -> Column:
    """The diff, with one line feed at its end; empty where there is none."""
    return F.when(text.stripped(F.coalesce(run["diff"], F.lit(""))) == "", F.lit("")).otherwise(text.patch_text(run["diff"]))


def own_reward(run: dict[str, Column]) -> Column:
    """The score that the run itself reports."""
    return F.create_map(F.lit("score"), run["reward"].cast("double"))


@dataclass(frozen=True)
class Environment:
    #: Names that are this, or begin with this and a colon, are its environments.
    name: str
    source: str
    evaluate: Callable[[dict[str, Column]], Column] = own_reward
    patch: Callable[[dict[str, Column]], Column] = git_diff
    #: Columns of a finished run that evaluate and patch read.
    reads: tuple[str, ...] = ("reward", "diff")
    image: Callable[[Column], Column] = field(default=lambda meta: F.get_json_object(meta, "$.docker_image"))
    workspace: Callable[[Column], Column] = field(default=lambda meta: F.coalesce(F.get_json_object(meta, "$.workspace_path"), F.lit("/app")))
    system_prompt: str | None = None

    def matches(self, env_name: Column) -> Column:
        return (env_name == self.name) | env_name.startswith(self.name + ":")

    def task_source(self) -> Callable[..., DataFrame]:
        return files.task_source(self.source)


#: The first that matches a name has it.
ENVIRONMENTS: list[Environment] = [
    Environment("swe-rebench", "swe_rebench", pytest_breakdown, git_diff, ("log", "diff")),
    Environment("verifiers", "verifiers", own_reward, git_diff, ("reward", "diff")),
]


def register_env(env: Environment) -> None:
    """Puts an environment before the others, so that it can take names from them."""
    ENVIRONMENTS.insert(0, env)


def known_envs() -> list[str]:
    return [e.name for e in ENVIRONMENTS]


def get_env(env_name: str) -> Environment:
    """The environment of a name; a name that none has is an error."""
    for env in ENVIRONMENTS:
        if env_name == env.name or env_name.startswith(env.name + ":"):
            return env
    raise ValueError(f"no environment for {env_name!r}; known: {', '.join(known_envs())}")


def graded(runs: DataFrame) -> DataFrame:
    """Finished runs (env_name and the columns that environments read) with breakdown, reward and patch, each row by its own environment.

    Columns that runs lack count as null. A name that no environment has is an error.
    """
    at = {c: F.col(c) if c in runs.columns else F.lit(None).cast("double" if c == "reward" else "string") for e in ENVIRONMENTS for c in e.reads}
    breakdown = F.raise_error(F.concat(F.lit("no environment for "), F.col("env_name"))).cast("map<string,double>")
    patch = F.lit(None).cast("string")
    for env in reversed(ENVIRONMENTS):
        breakdown = F.when(env.matches(F.col("env_name")), env.evaluate(at)).otherwise(breakdown)
        patch = F.when(env.matches(F.col("env_name")), env.patch(at)).otherwise(patch)
    return runs.withColumns({"breakdown": breakdown, "patch": patch}).withColumn("reward", F.try_element_at("breakdown", F.lit("score")))
