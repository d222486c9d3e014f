"""meterwise: usage-cost analytics and weekly forecasting on Spark."""

__version__ = "0.1.0"
