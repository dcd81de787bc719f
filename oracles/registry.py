from oracles import audit, decisions, metrics


def oracle_sql() -> dict[str, str]:
    return {**audit.SQL, **metrics.SQL, **decisions.SQL}
