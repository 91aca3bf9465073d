from .protect import decrypt_columns, encrypt_columns, mask, mask_columns, read_passphrase

__all__ = ["decrypt_columns", "encrypt_columns", "mask", "mask_columns", "read_passphrase"]
