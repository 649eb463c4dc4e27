"""Read-only SQL over an allow-list of sources.

The statement is judged by its plan: Spark's own parser and analyser say what it
reads and calls, so neither comments nor strings, quoting or spacing hide
anything, and words in strings and aliases mean nothing. A line of defence for SQL
written by others, not a sandbox: it runs with the rights of the Spark application.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from opsframe.sources.tables import Source, register_sources

_CATALYST = "org.apache.spark.sql.catalyst."
_PLANS = _CATALYST + "plans.logical."
_EXPRESSIONS = _CATALYST + "expressions."
# Plans that change something or run a script, and names made up by an expression.
FORBIDDEN_PLANS = (
    _PLANS + "Command",
    _PLANS + "ParsedStatement",
    _PLANS + "CompoundPlanStatement",
    _PLANS + "ScriptTransformation",
    _CATALYST + "analysis.PlanWithUnresolvedIdentifier",
)
FORBIDDEN_PARSED = (_CATALYST + "analysis.ExpressionWithUnresolvedIdentifier",)
# Relations that read nothing stored.
OWN_RELATIONS = ("LocalRelation", "OneRowRelation", "Range", "CTERelationRef", "UnionLoopRef", "EmptyRelation")
# Expressions that run code which is not Spark's own.
FORBIDDEN_EXPRESSIONS = (
    _EXPRESSIONS + "CallMethodViaReflection",
    _EXPRESSIONS + "UserDefinedExpression",
    _EXPRESSIONS + "ApplyFunctionExpression",
    _EXPRESSIONS + "PythonUDTF",
    _EXPRESSIONS + "UnevaluableGenerator",
)
#: Calls of a method of a given class: Spark uses them for its own functions.
CALLS = (_EXPRESSIONS + "objects.StaticInvoke", _EXPRESSIONS + "objects.Invoke", _EXPRESSIONS + "objects.NewInstance")


class _Trees:
    """Walks over Catalyst's trees in the JVM."""

    def __init__(self, session: SparkSession) -> None:
        self.jvm = session._jvm
        self.classes: dict[str, object] = {}

    def instance(self, node, names: Sequence[str]) -> bool:
        return any(self._class(name).isInstance(node) for name in names)

    def _class(self, name: str):
        if name not in self.classes:
            loader = self.jvm.Thread.currentThread().getContextClassLoader()
            self.classes[name] = self.jvm.java.lang.Class.forName(name, False, loader)
        return self.classes[name]

    @staticmethod
    def each(found) -> Iterator:
        every = found.iterator()
        while every.hasNext():
            yield every.next()

    def expressions(self, plan) -> Iterator:
        """All expressions of one node, with those inside them."""
        left = list(self.each(plan.expressions()))
        while left:
            one = left.pop()
            yield one
            left += self.each(one.children())

    def nodes(self, plan, leave) -> Iterator:
        """All nodes, those of subqueries as well, but for what stands below a node to ``leave``."""
        left = [plan]
        while left:
            one = left.pop()
            yield one
            if leave(one):
                continue
            left += self.each(one.children())
            # Named subqueries before analysis, and plans inside expressions, are not children.
            left += [x for x in self.each(one.innerChildren()) if self.instance(x, [_PLANS + "LogicalPlan"])]
            for expression in self.expressions(one):
                if self.instance(expression, [_EXPRESSIONS + "PlanExpression"]):
                    left.append(expression.plan())


def _name(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _wrapped(sql: str) -> str:
    # The line break ends a comment on the last line.
    return f"SELECT * FROM (\n{sql}\n)"


def check_sql(sql: str, session: SparkSession | None = None) -> None:
    """ValueError when the statement is more than a query, or runs a script; nothing is analysed.

    What is no query at all, or several statements, fails to parse.
    """
    session = session or SparkSession.active()
    trees = _Trees(session)
    parsed = session._jsparkSession.sessionState().sqlParser().parsePlan(_wrapped(sql))
    for node in trees.nodes(parsed, lambda _: False):
        if trees.instance(node, FORBIDDEN_PLANS):
            raise ValueError(f"not allowed in guarded SQL: {_name(node)}")
        for expression in trees.expressions(node):
            if trees.instance(expression, FORBIDDEN_PARSED):
                raise ValueError(f"not allowed in guarded SQL: {_name(expression)}")


def check_plan(session: SparkSession, plan, allowed: Sequence[str]) -> None:
    """ValueError when an analysed plan reads anything but the allowed views or runs other code."""
    trees = _Trees(session)
    names = {name.lower() for name in allowed}

    def own_view(node) -> bool:
        if _name(node) != "View" or not node.isTempView():
            return False
        name = node.desc().identifier()
        return name.database().isEmpty() and name.table().lower() in names

    for node in trees.nodes(plan, own_view):
        if own_view(node):
            continue
        if _name(node) == "View" or (node.children().isEmpty() and _name(node) not in OWN_RELATIONS):
            raise ValueError(f"not on the allow-list: {node.simpleString(200)}")
        if trees.instance(node, FORBIDDEN_PLANS):
            raise ValueError(f"not allowed in guarded SQL: {_name(node)}")
        for expression in trees.expressions(node):
            if trees.instance(expression, FORBIDDEN_EXPRESSIONS) or (
                trees.instance(expression, CALLS) and not _called(expression).startswith("org.apache.spark.sql.")
            ):
                raise ValueError(f"not allowed in guarded SQL: {expression.prettyName()}")


def _called(call) -> str:
    """The class whose code a call runs."""
    kind = _name(call)
    if kind == "StaticInvoke":
        return call.staticObject().getName()
    if kind == "NewInstance":
        return call.cls().getName()
    target = call.targetObject()
    return target.value().getClass().getName() if _name(target) == "Literal" else _called(target) if _name(
        target
    ) in ("StaticInvoke", "Invoke", "NewInstance") else target.dataType().getClass().getName()


def guarded_sql(
    spark: SparkSession, sources: Sequence[Source], sql: str, max_rows: int | None = None
) -> DataFrame:
    """Result of one SELECT over the sources; with ``max_rows``, at most so many rows of it.

    Runs in a new session that holds only the given views and cannot read files
    by path. The statement is nested as a subquery, so anything but a query
    fails to parse; it is analysed, which runs nothing, and its plan is refused if
    it reads any other relation, in subqueries and named queries too, or calls
    code that is not Spark's own. Unknown names fail here, before a job starts.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    names = register_sources(session, sources)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    check_sql(sql, session)
    result = session.sql(_wrapped(sql))
    check_plan(session, result._jdf.queryExecution().analyzed(), names)
    return result if max_rows is None else result.limit(max_rows)
