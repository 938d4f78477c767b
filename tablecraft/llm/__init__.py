"""Operations of a pipeline that prepares training text."""
