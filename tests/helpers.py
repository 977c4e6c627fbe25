"""What tests read off frames."""


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def nodes_of(df, name):
    """The nodes of the physical plan of that name, each as the names of the columns it puts out. Needs adaptive execution off."""
    found, open_ = [], [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName() == name:
            columns = node.output()
            found.append([columns.apply(k).name() for k in range(columns.size())])
        children = node.children()
        open_ += [children.apply(k) for k in range(children.size())]
    return found
