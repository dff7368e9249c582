from tidewater.operators import aggregates, filters, joins, partitioning, projections, ranking

__all__ = ["aggregates", "filters", "joins", "partitioning", "projections", "ranking"]
