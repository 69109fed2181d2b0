"""Activity sections by division range.

Fixed values (must equal the reference for identical output): inclusive
division range, section letter, section label. Divisions outside every range
(0, 4, 34, 40, 44, 48, 54, 57, 67, 76, 83, 89, 98) have no section.
"""

SECTIONS = [
    (1, 3, "A", "AGROPECUÁRIA"),
    (5, 9, "B", "EXTRATIVA"),
    (10, 33, "C", "INDÚSTRIA"),
    (35, 35, "D", "ENERGIA"),
    (36, 39, "E", "SANEAMENTO"),
    (41, 43, "F", "CONSTRUÇÃO"),
    (45, 47, "G", "COMÉRCIO"),
    (49, 53, "H", "TRANSPORTE"),
    (55, 56, "I", "ALIMENTAÇÃO"),
    (58, 63, "J", "INFORMAÇÃO"),
    (64, 66, "K", "FINANÇAS"),
    (68, 68, "L", "IMÓVEIS"),
    (69, 75, "M", "PROFISSIONAL"),
    (77, 82, "N", "ADMINISTRAÇÃO"),
    (84, 84, "O", "PÚBLICO"),
    (85, 85, "P", "EDUCAÇÃO"),
    (86, 88, "Q", "SAÚDE"),
    (90, 93, "R", "CULTURA"),
    (94, 96, "S", "OUTROS"),
    (97, 97, "T", "DOMÉSTICO"),
    (99, 99, "U", "INTERNACIONAL"),
]

# The two literal dimensions of the star schema.
SIZE_ROWS = [
    ("00", "Não Informado"),
    ("01", "Micro Empresa"),
    ("03", "Empresa de Pequeno Porte"),
    ("05", "Demais"),
]
REGIME_ROWS = [
    (1, "MEI"),
    (2, "Simples Nacional"),
    (3, "Lucro Presumido / Real"),
]
