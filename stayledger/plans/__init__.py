"""The layers built from the operators: cleaned tables, star schema, KPIs, scoped metrics and checks."""
