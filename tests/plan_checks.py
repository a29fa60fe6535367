"""What tests look up in Spark's plans."""


def rows_written_to_shuffle(frame):
    """Records the exchanges of a finished plan wrote."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return total


def finished_plan(frame):
    """The text of a plan as it ran, where exchanges that were run once for several uses say so."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    return plan.toString().partition("== Initial Plan ==")[0]


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
