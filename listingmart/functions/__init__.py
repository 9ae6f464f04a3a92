"""Column -> Column expressions: text (F1-F13), arrays and NULL handling (P5-P7, P13, F12-F24),
dates and windows (S8-S10, F26-F31). No Python UDFs."""
