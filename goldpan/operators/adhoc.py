"""Ad-hoc SQL over the gold views, and bounded results."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession

AGENT_ROWS = 20
BENCH_ROWS = 10
PREVIEW_ROWS = 5


# What a query may be made of; everything else is refused. Parsed nodes of plans and expressions, by class name.
_PLANS = set(
    """Aggregate Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation
    Pivot Project Sample Sort SubqueryAlias Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases
    UnresolvedTVFAliases UnresolvedTableValuedFunction UnresolvedWith Unpivot Window WithWindowDefinition""".split()
)
_UNRESOLVED = set(
    """MultiAlias UnresolvedAlias UnresolvedAttribute UnresolvedExtractValue UnresolvedFunction UnresolvedGenerator UnresolvedInlineTable UnresolvedNamedLambdaVariable
    UnresolvedOrdinal UnresolvedStar UnresolvedStarExceptOrReplace UnresolvedStarWithColumns UnresolvedSubqueryColumnAliases""".split()
)
_SUBQUERIES = {"Exists", "InSubquery", "LateralSubquery", "ListQuery", "ScalarSubquery"}
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"}
# Groups of built-in functions that compute from their arguments alone. Functions of no group (those of the user) and of other
# groups (Java methods, files, the session) are refused, and so is any name with a qualifier.
_GROUPS = set(
    """agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs datetime_funcs generator_funcs hash_funcs
    json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs url_funcs window_funcs""".split()
)
_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
_ANALYSIS = "org.apache.spark.sql.catalyst.analysis."
# Resolved leaves that hold no stored rows; all others must lie inside a view.
_LEAVES = {"CTERelationRef", "LocalRelation", "OneRowRelation", "Range", "UnionLoopRef"}
# Resolved expressions that run code from outside or tell of the session; some are written without brackets.
_OUTSIDE = set(
    """CallMethodViaReflection TryReflect ScalaUDF ScalaUDAF PythonUDF PythonUDAF InputFileName CurrentUser CurrentDatabase CurrentCatalog
    SparkVersion""".split()
)


class UnsafeQuery(ValueError):
    """The query uses a feature that reaches outside the views."""


def _each(items) -> list:
    return [items.apply(i) for i in range(items.size())]


class _Check:
    """Walks the plan of a query, as parsed and again as resolved.

    The parsed walk comes first, since resolving already opens files and evaluates names given as expressions.
    """

    def __init__(self, spark: SparkSession, views: Collection[str] | None):
        self.state = spark._jsparkSession.sessionState()
        self.identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
        self.views = None if views is None else {v.lower() for v in views}

    def is_view(self, name: str) -> bool:
        if self.views is not None:
            return name.lower() in self.views
        return "." not in name and self.state.catalog().getTempView(name).isDefined()

    def parsed(self, node, own: frozenset[str] = frozenset()) -> None:
        """``own`` are the names of the common table expressions in sight."""
        kind = node.getClass().getSimpleName()
        if kind not in _PLANS:
            raise UnsafeQuery(f"The query may not use {kind}.")
        if kind == "UnresolvedRelation":
            name = _each(node.multipartIdentifier())
            if not (len(name) == 1 and name[0].lower() in own) and not self.is_view(".".join(name)):
                raise UnsafeQuery(f"The query may only read the given views, not {'.'.join(name)}.")
        if kind == "UnresolvedWith":
            for cte in _each(node.cteRelations()):
                inner = own | {cte._1().lower()} if node.allowRecursion() else own
                self.parsed(cte._2(), inner)
                own = own | {cte._1().lower()}
        if kind == "UnresolvedTableValuedFunction":
            name = _each(node.name())
            if len(name) != 1 or name[0].lower() not in _TABLE_FUNCTIONS:
                raise UnsafeQuery("The query may not call this table function.")
        for expression in _each(node.expressions()):
            self.parsed_expression(expression, own)
        for child in _each(node.children()):
            self.parsed(child, own)

    def parsed_expression(self, expression, own: frozenset[str]) -> None:
        whole, kind = expression.getClass().getName(), expression.getClass().getSimpleName()
        if not (whole.startswith(_EXPRESSIONS) or whole.startswith(_ANALYSIS) and kind in _UNRESOLVED):
            raise UnsafeQuery(f"The query may not use {kind}.")
        if kind == "UnresolvedFunction":
            self.function(_each(expression.nameParts()))
        if kind == "UnresolvedGenerator":
            self.function(expression.name().unquotedString().split("."))
        if kind in _SUBQUERIES:
            self.parsed(expression.query().plan() if kind == "InSubquery" else expression.plan(), own)
        elif "Subquery" in kind:
            raise UnsafeQuery(f"The query may not use {kind}.")
        for child in _each(expression.children()):
            self.parsed_expression(child, own)

    def function(self, name: list[str]) -> None:
        found = self.state.functionRegistry().lookupFunction(self.identifier(name[-1])) if len(name) == 1 else None
        if found is None or found.isEmpty() or found.get().getGroup() not in _GROUPS:
            raise UnsafeQuery(f"The query may not call {'.'.join(name)}.")

    def resolved(self, node) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "View":
            name = node.desc().identifier()
            if not (self.is_view(name.table()) or self.is_view(name.unquotedString())):
                raise UnsafeQuery("The query may only read the given views.")
            return
        children = [*_each(node.children()), *_each(node.innerChildren())]
        if not children and kind not in _LEAVES:
            raise UnsafeQuery(f"The query may only read the given views, not {kind}.")
        for expression in _each(node.expressions()):
            self.resolved_expression(expression)
        for child in children:
            self.resolved(child)

    def resolved_expression(self, expression) -> None:
        kind = expression.getClass().getSimpleName()
        if kind in _OUTSIDE or kind.startswith("Hive"):
            raise UnsafeQuery(f"The query may not use {kind}.")
        if kind in _SUBQUERIES and kind != "InSubquery":
            self.resolved(expression.plan())
        for child in _each(expression.children()):
            self.resolved_expression(child)


def run_select(spark: SparkSession, sql: str, n: int = AGENT_ROWS, views: Collection[str] | None = None) -> DataFrame:
    """At most ``n`` rows of one query.

    The text becomes a subquery, so commands and several statements cannot be parsed, and the limit is part of the
    plan. The query may read the given ``views`` (by default the session's temporary views) and its own common table
    expressions, and call built-in functions of their arguments. Its plan is walked as parsed and as resolved, against lists of what is known to be
    harmless: no files, other tables, names made by expressions, programs, Java methods or functions of the user.
    """
    bounded_sql = f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n) q LIMIT {int(n)}"
    check = _Check(spark, views)
    check.parsed(check.state.sqlParser().parsePlan(bounded_sql))
    rows = spark.sql(bounded_sql)
    check.resolved(rows._jdf.queryExecution().analyzed())
    return rows


def try_select(spark: SparkSession, sql: str, n: int = AGENT_ROWS, views: Collection[str] | None = None) -> tuple[DataFrame | None, str]:
    """The query's rows and an empty text, or no rows and why the SQL was refused."""
    try:
        return run_select(spark, sql, n, views), ""
    except (AnalysisException, ParseException, UnsafeQuery) as error:
        return None, str(error)


def bounded(frame: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """The first ``n`` rows in a given order, safe to take to the driver: a top-k, not a full sort."""
    return frame.orderBy(*order_by).limit(n)
