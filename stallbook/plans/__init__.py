"""The data flow: clean files -> staging -> intermediate -> marts -> reports."""
