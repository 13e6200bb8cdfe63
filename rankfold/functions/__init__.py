"""Column, name and schema helpers shared by the stages."""
