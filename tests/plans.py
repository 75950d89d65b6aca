"""Plan text for assertions."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_plans(spark) -> list[str]:
    """Plans of the writes so far, oldest first."""
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = [store.apply(i).physicalPlanDescription() for i in range(store.size())]
    return [p for p in found if "InsertIntoHadoopFsRelationCommand" in p]
