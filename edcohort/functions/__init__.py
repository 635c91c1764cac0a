"""Column-expression builders.  Everything here returns ``Column`` objects that
stay inside whole-stage codegen; no Python UDF is used."""
