"""Invented detail pages per source (full / missing fields / blocked /
malformed), built to carry exactly the markup each rule set reads."""

GETONBOARD_FULL = """<html><body>
<h1 class="gb-landing-cover__title"> Data <b>Engineer</b> </h1>
<a class="tooltipster" href="/companies/acme">ACME SA</a>
<span itemprop="jobLocation"><a href="/empleos/ciudad/cordoba">Córdoba</a> (Remoto)</span>
<div class="gb-rich-txt"><p>Build pipelines.</p></div><div class="gb-rich-txt"><p>Use Spark.</p></div>
<a class="gb-tags__item">python</a><a class="gb-tags__item">spark</a>
<span class="tag bg_brand_light">SQL</span><span class="tag bg_brand_light">Python</span>
<ul class="disc mbB"><li>SQL</li><li>Airflow</li></ul>
<time itemprop="datePosted" datetime="2024-04-17">17 abr</time>
<span itemprop="minValue" content="1000"></span><span itemprop="maxValue" content="2000"></span>
<span itemprop="currency" content="USD"></span><span itemprop="unitText" content="MONTH"></span>
<div class="size0 mt1"> 12 postulantes </div>
<span itemprop="qualifications">Semi Senior</span>
<h2 class="size1"><span>Full time</span> <span>Remote</span></h2>
</body></html>"""

GETONBOARD_MISSING = """<html><body><h1>Analista</h1>
<div class="color-hierarchy2"><time>hace 2 días</time></div></body></html>"""

ZONAJOBS_FULL = """<html><body>
<h1> Analista de Datos </h1>
<a href="/perfiles/empresa_x">Empresa X</a>
<i name="icon-location"></i><h2>Tecnología</h2><h2>Publicado hace 3 días</h2><h2>Palermo, Buenos Aires</h2>
<i name="icon-office"></i><p>Modalidad</p><i name="icon-office"></i><p>Híbrido</p>
<i name="icon-clock"></i><p>Full-time</p>
<i name="icon-award"></i><p>Senior</p>
<div id="ficha-detalle"><div>head</div><div><div><div> Descripción del puesto </div></div></div></div>
</body></html>"""

INDEED_JSONLD = """<html><head><meta name="description" content="job">
<script type="application/ld+json">{"title": "Data Analyst", "hiringOrganization": {"name": "Globant"},
"jobLocation": {"address": {"addressLocality": "Rosario"}}, "employmentType": "FULL_TIME",
"datePosted": "2024-04-10", "description": ""}</script></head>
<body><div id="jobDescriptionText"><p>Line one</p><p>Line two</p></div></body></html>"""

INDEED_NO_JSONLD = """<html><body>
<h1 data-testid="jobsearch-JobInfoHeader-title">BI Developer</h1>
<a data-testid="company-name">Mercado</a>
<div data-testid="jobsearch-JobInfoHeader-location">CABA</div>
<div id="jobDescriptionText"><p>Only text</p></div></body></html>"""

INDEED_MALFORMED = """<html><head><script type="application/ld+json">{"title": "Broken",</script></head>
<body><h1 data-testid="jobsearch-JobInfoHeader-title">Fallback Title</h1>
<div id="jobDescriptionText">Desc</div></body></html>"""

INDEED_NOTHING = "<html><body><h1>Nothing here</h1></body></html>"

INDEED_BLOCKED = "<html><body><h2>Solicitud bloqueada</h2><p>Ray ID: 123</p></body></html>"

COMPUTRABAJO_FULL = """<html><body>
<div class="container">nav</div>
<div class="container"><h1 class="fwB fs24 mb5 box_detail w100_m"> Analista BI </h1>
<p class="fs16"> Grupo Metropol - Sub - San Nicolás, Capital Federal </p></div>
<div div-link="oferta"><p>Tareas: reportes</p><p>  </p><p>Requisitos: SQL</p></div>
<span class="tag base mb10">Jornada completa</span><span class="tag base mb10">Presencial y remoto</span>
<span class="tag base mb10">Salario a convenir</span>
<span class="tag bg_brand_light fc_base">Power BI</span><ul class="disc mbB"><li>SQL</li><li>Power BI</li></ul>
<p class="fc_aux fs13">Hace 3 días</p>
</body></html>"""

COMPUTRABAJO_NO_SEP = """<html><body><div class="container"></div>
<div class="container"><h1>Cajero</h1><p class="fs16">Solo Empresa</p></div>
<p class="fs16">Capital Federal</p></body></html>"""

PORTAL_FULL = """<html><body>
<h3 class="text-capitalize text-turqueza">operario de depósito</h3>
<div><strong>MARIA ALICIA MARTINELLI</strong></div>
<div class="col-md-12"><p><span>Rosario, Santa Fe (presencial)</span></p></div>
<div class="row"><label class="fw-600">Disponibilidad horaria</label><p>Tiempo Completo</p></div>
<div class="row"><h2>Requisitos</h2></div>
<div class="row"><label class="fw-600">Experiencia Requerida</label><p>No</p>
<label class="fw-600">Educación</label><p>Secundario completo</p>
<label class="fw-600">Idiomas</label><p>no</p></div>
<div><h2>Resumen del puesto</h2><p>Carga y descarga.</p><p>Control de stock.</p><h2>Otros</h2><p>x</p></div>
<p>Salario: A convenir. Publicado el 05/03/2024</p>
</body></html>"""

MALFORMED = None  # a failed fetch: no HTML at all

PORTAL_TWO_AVAILABILITY = """<html><body><h3>Chofer</h3>
<label class="fw-600">Disponibilidad</label><p>A definir</p>
<label class="fw-600">Disponibilidad horaria</label><p>Tiempo parcial</p></body></html>"""

GETONBOARD_EMPTY_LOCATION = """<html><body><h1>Dev</h1>
<span itemprop="jobLocation"><a href="/x"> </a></span><a href="/empleos/ciudad/rosario">Rosario</a></body></html>"""

COMPUTRABAJO_BLANK_DESC = """<html><body><div class="container"></div><div class="container">
<h1 class="fwB fs24 mb5 box_detail w100_m">  </h1><h1>Other</h1><p class="fs16">   </p></div>
<div div-link="oferta" class="mb40 pb40 bb1"><p> </p>whole block</div></body></html>"""

LISTING_GETONBOARD = """<html><body><div class="gb-results-list">
<a href="/empleos/data-engineer-acme">A</a><a href="https://www.getonbrd.com/empleos/x">B</a><a href="">empty</a></div>
<a href="/outside">not listed</a></body></html>"""

LISTING_ZONAJOBS = """<html><body><main id="listado-avisos"><a href="/empleos/1.html">1</a><a href="/perfiles/co">co</a>
<div><a href="/empleos/1.html">dup</a></div></main></body></html>"""

LISTING_INDEED = """<html><body><a href="/rc/clk?jk=abc123&from=serp">x</a><a href="https://ar.indeed.com/viewjob?jk=abc123">y</a>
<a href="/viewjob?jk=zz9">z</a><a href="/other">o</a></body></html>"""

LISTING_PORTAL = """<html><body><a class="btn btn-success comp-button-ciudadanos" href="Oferta/7">ver</a></body></html>"""

LISTING_COMPUTRABAJO = """<html><body><a class="js-o-link fc_base" href="https://www.computrabajo.com.ar/ofertas-de-trabajo/1">t</a></body></html>"""

ZONAJOBS_MISSING = """<html><body><h1>Vendedor</h1><i name="icon-location"></i><h2>Ventas</h2></body></html>"""

ZONAJOBS_MALFORMED = """<html><body><h1>Cadete <b>urgente</h1><i name="icon-location"></i><h2>Log</h2><h2>Ayer
<h2>Rosario</h2></div></div><p>stray</span>"""

PORTAL_MISSING = """<html><body><h3>Ayudante</h3><p>Sin más datos</p></body></html>"""

PORTAL_MALFORMED = """<html><body><h3 class="text-capitalize text-turqueza">Mozo<strong>Bar Sur</strong>
<div class="col-md-12"><p><span>Salta (presencial)</span><label class="fw-600">Experiencia Requerida<p>Sí"""
