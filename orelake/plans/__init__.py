"""The layered build, stage by stage.  Each stage reads stored tables and writes stored tables."""
