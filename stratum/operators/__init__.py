"""Layer operators: bronze, silver, gold, fraud scoring, window operators, reports."""
