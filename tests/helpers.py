from __future__ import annotations


def rows(df) -> list[tuple]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    columns = sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(*columns).collect()))


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = connection.sql(sql)
    columns = sorted(relation.columns)
    found = connection.sql(f"SELECT {', '.join(columns)} FROM ({sql}) AS result").fetchall()
    return columns, sorted(tuple(str(v) for v in r) for r in found)


def values(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def plan_nodes(df) -> list:
    """All nodes of the plan that ran when ``df`` was collected."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        found.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(k) for k in range(children.size())]
    return found


def metric(df, node: str, name: str) -> list[int]:
    """A metric's value at every node of that kind."""
    found = []
    for n in plan_nodes(df):
        if n.getClass().getSimpleName() == node and n.metrics().contains(name):
            found.append(n.metrics().apply(name).value())
    return found
