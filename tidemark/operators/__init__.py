"""Campaign operators P1-P31: pure DataFrame -> DataFrame functions."""
