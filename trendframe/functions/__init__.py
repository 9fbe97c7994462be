from trendframe.functions.scalar import safe_div, tsql_like

__all__ = ["safe_div", "tsql_like"]
