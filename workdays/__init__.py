"""Workdays: call-centre activity reporting as Spark DataFrame plans.

Layers:
  functions/  column expressions (normalising text, presentation)
  sources/    reading delimited exports and tables, writing sinks
  operators/  filters, first-wins load, bounded broadcast, totals
  plans/      the reports and jobs built from the operators
  streaming/  the continuous form of the load
"""

